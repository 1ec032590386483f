"""Personal-data masks and counts as columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.functions import text as X


def _jvm_pattern(pattern: str) -> str:
    """Spell the word, digit and space classes out, so that they cover all of
    Unicode whatever the Java release takes ``\\b``, ``\\d`` and ``\\s`` to be."""
    word = f"[{fixed.WORD_CLASS}]"
    boundary = f"(?:(?<={word})(?!{word})|(?<!{word})(?={word}))"
    return (
        pattern.replace(r"[\s\-]", rf"[{fixed.SPACE_CLASS}\-]")
        .replace(r"\b", boundary)
        .replace(r"\d", fixed.DIGIT_CLASS)
    )


JVM_PATTERNS = {name: _jvm_pattern(fixed.PII_PATTERNS[name]) for name in fixed.PII_TYPES}

# What a match cannot do without; cheaper to look for than the match itself.
_NEEDED = {
    "email": lambda text: text.contains("@"),
    "phone": lambda text: text.rlike(r"\p{Nd}{3}"),
    "ssn": lambda text: text.rlike(r"\p{Nd}-\p{Nd}"),
    "credit_card": lambda text: text.rlike(r"\p{Nd}{4}"),
    "ip_address": lambda text: text.rlike(r"\p{Nd}\.\p{Nd}"),
}


def pii_count(text: Column, pii_type: str) -> Column:
    """Matches of one type in the text as given (null text has none)."""
    n = F.regexp_count(text, F.lit(JVM_PATTERNS[pii_type]))
    return F.when(_NEEDED[pii_type](text), n).otherwise(F.lit(0))


def pii_counts(text: Column) -> Column:
    """All types but the address need a digit, which most texts lack: one look instead of four."""
    counts = lambda types: F.struct(
        *[(pii_count(text, t) if t in types else F.lit(0)).alias(t) for t in fixed.PII_TYPES]
    )
    return F.when(text.rlike(r"\p{Nd}"), counts(fixed.PII_TYPES)).otherwise(counts(["email"]))


def mask_by_counts(text: Column, counts: Column) -> Column:
    """Replace, type by type, what the untouched text was found to hold.  Texts
    without any finding, nearly all of them, are passed through."""
    def applied(t):
        return lambda m: F.when(
            counts[t] > 0, F.regexp_replace(m, JVM_PATTERNS[t], fixed.PII_TOKENS[t])
        ).otherwise(m)

    masked = text
    for t in fixed.PII_TYPES:
        masked = X.let(masked, applied(t))
    found = sum((counts[t] for t in fixed.PII_TYPES[1:]), counts[fixed.PII_TYPES[0]])
    return F.when(found > 0, masked).otherwise(text)


def mask_pii(text: Column) -> Column:
    both = F.struct(text.alias("text"), pii_counts(text).alias("counts"))
    return X.let(both, lambda b: mask_by_counts(b["text"], b["counts"]))
