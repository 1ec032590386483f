"""Quality rules: a table of thresholds compiled into one projection."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.text import let
from colloquy.llm.words import word_array

#: Characters counted as symbols, words of a repetition window.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is was for on that with as by at from this it be are or an a not but "
    "le la les de des du et en un une que qui dans pour sur il est au par pas ce "
    "der die das und ist nicht mit den von zu ein eine auf im dem sich für "
    "el los las y del se por con su para lo al como"
).split()
#: The languages of ``STOP_WORDS``.
LANGUAGES = ("en", "fr", "de", "es")


@dataclass(frozen=True)
class Rule:
    """A text fails if ``part`` is below ``least`` or above ``most`` per unit of ``whole`` (both
    names of measures; no ``whole``: the measure itself).  A ratio over zero passes.  With ``langs`` only
    texts of these languages can fail."""

    name: str
    part: str
    whole: str | None = None
    least: float | None = None
    most: float | None = None
    langs: tuple[str, ...] | None = None


BASE = [
    Rule("too_short", "n_words", least=20),
    Rule("repeated_words", "n_repeat_words", "n_words", most=0.3),
]
MORE = [
    Rule("word_length", "word_chars", "n_words", least=2.5, most=12),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.04, langs=LANGUAGES),
    Rule("same_lines", "n_dup_lines", "n_lines", most=0.5),
]
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_stop_words", "n_lines",
]


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words inside windows that occur twice or more.  Windows are sorted by hash with their
    places; each place that has an equal neighbour adds the words its window covers first."""
    places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s):
        same = lambda i: F.get(s, i)["h"].eqNullSafe(F.get(s, i - 1)["h"]) | F.get(s, i)[
            "h"
        ].eqNullSafe(F.get(s, i + 1)["h"])
        return F.transform(
            F.filter(F.sequence(F.lit(0), F.size(s) - 1), same), lambda i: F.get(s, i)["i"]
        )

    start = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n"))
    return F.aggregate(
        F.sort_array(let(places, repeated)),
        start,
        lambda a, x: F.struct(x.alias("at"), (a["n"] + F.least(F.lit(WINDOW), x - a["at"])).alias("n")),
        lambda a: a["n"],
    )


def _window_hashes(words: Column) -> Column:
    return let(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
        ),
    )


def measured(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and the measures of each text.

    Null is the empty text, which has no words and no lines; repeated rows are measured each.
    Windows of one text are compared by 64-bit hashes.  Row-local: no shuffle, no user
    function; a text of n words costs n log n at most."""
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<bigint>")
    words = df.select(*keep, whole.alias("__text"), word_array(F.col(text)).alias("__w")).select(
        "*",
        F.when(F.size("__w") >= WINDOW, _window_hashes(F.col("__w"))).otherwise(none).alias("__h"),
        F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
    )
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    columns = {
        "n_words": F.size("__w"),
        "word_chars": F.length(F.array_join("__w", "")),
        "n_symbols": F.length("__text") - F.length(F.regexp_replace("__text", SYMBOLS, "")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.when(repeats, _repeat_words(F.col("__w"), F.col("__h"))).otherwise(0),
        "n_stop_words": F.size(F.filter("__w", lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_lines": F.size("__lines"),
    }
    return words.select(*keep, *[columns[m].cast("long").alias(m) for m in MEASURES])


def fails(rule: Rule, lang: Column | None = None) -> Column:
    """Whether a measured row breaks the rule; never null."""
    part, per = F.col(rule.part), F.lit(1) if rule.whole is None else F.col(rule.whole)
    broken = F.lit(False)
    if rule.least is not None:
        broken = broken | (part < per * F.lit(rule.least))
    if rule.most is not None:
        broken = broken | (part > per * F.lit(rule.most))
    if rule.langs is not None and lang is not None:
        broken = broken & F.coalesce(lang.isin(*rule.langs), F.lit(False))
    return broken


def judged(
    df: DataFrame, keep: list[str], text: str = "text", base: list[Rule] = BASE, more: list[Rule] = MORE,
    lang: Column | None = None,
) -> DataFrame:
    """``measured`` plus ``base_failed``, ``kept`` and ``broken`` (the names of the rules that
    the text breaks).  Only ``keep`` columns are carried on, so other columns may have any name.

    ``lang`` tells a text's language; a rule for some languages passes texts of others and of none known.
    Without ``lang`` all rules hold for all texts.  An empty table gives an empty table."""
    said = None if lang is None else F.col("__lang")
    names = F.filter(
        F.array(*[F.when(fails(r, said), F.lit(r.name)) for r in [*base, *more]]), lambda x: x.isNotNull()
    )
    failed = F.lit(False)
    for rule in base:
        failed = failed | fails(rule, said)
    rows = measured(df, keep, text) if lang is None else measured(df.withColumn("__lang", lang), [*keep, "__lang"], text)
    return (
        rows.withColumns({"base_failed": failed, "broken": names})
        .withColumn("kept", F.size("broken") == 0)
        .drop("__lang")
    )
