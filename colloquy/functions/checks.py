"""Keyword coverage and answer-format checks as columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.functions import text as X
from colloquy.functions.picks import constant


def keyword_coverage(
    prediction: Column,
    category: Column,
    keywords: dict[str, list[str]] | None = None,
    min_keywords: int = fixed.MIN_KEYWORDS,
) -> Column:
    """Struct ``score, found, missing, total``.  A keyword counts wherever it
    appears, inside longer words too.  Categories without a list score one."""
    lists = fixed.KEYWORDS if keywords is None else keywords
    chosen = F.coalesce(
        F.try_element_at(constant(lists, "map<string,array<string>>"), category),
        F.array().cast("array<string>"),
    )
    found = X.let(
        F.lower(X.text_or_empty(prediction)),
        lambda lowered: F.filter(chosen, lambda k: F.contains(lowered, k)),
    )

    def result(found):
        share = F.size(found).cast("double") / F.lit(float(max(min_keywords, 1)))
        return F.struct(
            F.when(F.size(chosen) == 0, F.lit(1.0))
            .otherwise(F.least(share, F.lit(1.0)))
            .alias("score"),
            found.alias("found"),
            F.array_except(chosen, found).alias("missing"),
            F.size(chosen).alias("total"),
        )

    return X.let(found, result)


def format_compliance(prediction: Column) -> Column:
    """Struct ``score, checks, passed, total``.  A text without words has no
    repetition check, so it is scored on four."""
    lowered = F.lower(X.text_or_empty(prediction))
    limit = fixed.FORMAT_MAX_WORD_SHARE

    def checks(text):
        return X.let(
            X.words(text),
            lambda t: F.struct(
                (F.size(t) >= fixed.FORMAT_MIN_WORDS).alias("adequate_length"),
                F.when(F.size(t) > 0, ~X.has_frequent_word(t, (limit, lambda share: share >= limit)))
                .alias("no_excessive_repetition"),
                X.any_inside(text, fixed.TONE_PHRASES).alias("professional_tone"),
                X.any_inside(text, fixed.CLOSING_PHRASES).alias("has_closing"),
                (~X.any_inside(text, fixed.PLACEHOLDER_PHRASES)).alias("no_placeholders"),
            ),
        )

    names = [
        "adequate_length", "no_excessive_repetition", "professional_tone",
        "has_closing", "no_placeholders",
    ]

    def result(c):
        passed = sum((F.coalesce(c[n].cast("int"), F.lit(0)) for n in names), F.lit(0))
        total = F.when(c["no_excessive_repetition"].isNull(), F.lit(4)).otherwise(F.lit(5))
        return F.struct(
            (passed.cast("double") / total).alias("score"),
            c.alias("checks"),
            passed.alias("passed"),
            total.alias("total"),
        )

    return X.let(X.let(lowered, checks), result)
