"""Judging URLs: host and path rules, and gradient-boosted trees on lexical features for the
URLs that no rule fits.

Training works on a bounded sample of the rules' URLs as DataFrame aggregates: a job
for each level of a tree brings a histogram of nodes x features x bins to the driver.  The
trees become one column expression.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.operators.lineage import settle

#: Labelled URLs used for training at most: those of the smallest hashes.
SAMPLE = 20_000
TREES, DEPTH, RATE, BINS = 10, 2, 0.4, 12
#: Gradients are summed as integers of this scale, so that the order of summing is of no account.
SCALE = 1_000_000
#: Rows that a suffix's block rate counts besides its own, at the overall rate.
PRIOR = 10.0
#: Groups of hosts; a row's suffix statistics in training are those of the other groups' rows.
FOLDS = 5

LEXICAL = [
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio",
    "entropy", "parameters", "hyphens", "first_part_length",
]
FEATURES = [*LEXICAL, "suffix_rate", "suffix_log_count"]


@dataclass(frozen=True)
class UrlRule:
    """``place`` is a host and a path, as ``example.com/en/``; ``verdict`` allow or block."""

    verdict: str
    place: str


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> tuple[Column, Column]:
    """Place and verdict of the longest rule that fits, null without one; of equal places the
    first rule counts."""
    place, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.place)):
        name, _, start = rule.place.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        place = F.when(fits, F.lit(rule.place)).otherwise(place)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return place, verdict


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _entropy(text: Column) -> Column:
    """Bits per character: the sorted characters are walked once, run by run."""
    n = F.length(text)
    gain = lambda run: F.when(run > 0, run * F.log2(run)).otherwise(F.lit(0.0))
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def step(a, c):
        same = c == a["c"]
        return F.struct(
            c.alias("c"),
            F.when(same, a["run"] + 1).otherwise(F.lit(1.0)).alias("run"),
            F.when(same, a["sum"]).otherwise(a["sum"] + gain(a["run"])).alias("sum"),
        )

    total = F.aggregate(F.sort_array(F.split(text, "")), start, step, lambda a: a["sum"] + gain(a["run"]))
    return F.when(n > 0, F.log2(n) - total / n).otherwise(F.lit(0.0))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    digits = lambda x: F.length(x) - F.length(F.regexp_replace(x, "[0-9]", ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    times = lambda x, c: F.length(x) - F.length(F.replace(x, F.lit(c), F.lit("")))
    columns = {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")),
        "labels": F.when(host == "", 0).otherwise(times(host, ".") + 1),
        "digit_ratio": _share(digits(url), F.length(url)),
        "host_digit_ratio": _share(digits(host), F.length(host)),
        "entropy": _entropy(url),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")),
        "hyphens": times(host, "-"),
        "first_part_length": F.length(F.regexp_extract(path, r"^/([^/]*)", 1)),
    }
    return {k: v.cast("double") for k, v in columns.items()}


def with_features(df: DataFrame, keep: list[str], url: str, rules: Sequence[UrlRule]) -> DataFrame:
    host, path = parts(F.col(url))
    rows = df.select(*keep, F.col(url).alias("__url"), host.alias("host"), path.alias("path"))
    place, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return rows.select(
        "*", place.alias("rule"), verdict.alias("ruled"),
        F.substring_index("host", ".", -1).alias("__suffix"),
        *[c.alias(f"f_{k}") for k, c in lexical(F.col("__url"), F.col("host"), F.col("path")).items()],
    )


@dataclass(frozen=True)
class Split:
    feature: int
    bin: int
    edge: float
    left: "Split | float"
    right: "Split | float"


class UrlModel:
    """Suffix statistics and trees; ``margin`` is the log odds of block."""

    def __init__(self, base: float, rate: float, suffixes: DataFrame | None):
        self.base, self.rate, self.suffixes, self.trees = base, rate, suffixes, []

    def joined(self, df: DataFrame) -> DataFrame:
        """Suffixes unknown to the training have the overall rate and no count."""
        if self.suffixes is None:
            none = F.lit(None).cast("double")
            df = df.withColumns({"s_rate": none, "s_count": none})
        else:
            df = df.join(self.suffixes, "__suffix", "left")
        return self.with_statistics(df)

    def with_statistics(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "f_suffix_rate": F.coalesce("s_rate", F.lit(self.rate)),
                "f_suffix_log_count": F.log1p(F.coalesce("s_count", F.lit(0.0))),
            }
        ).drop("s_rate", "s_count")

    def margin(self) -> Column:
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + _compiled(tree, lambda s: F.col(f"f_{FEATURES[s.feature]}") <= s.edge)
        return total


def _compiled(tree, goes_left) -> Column:
    if not isinstance(tree, Split):
        return F.lit(float(tree))
    return F.when(goes_left(tree), _compiled(tree.left, goes_left)).otherwise(
        _compiled(tree.right, goes_left)
    )


def fit(labelled: DataFrame, sample: int = SAMPLE) -> UrlModel:
    """Train on rows of ``with_features`` whose ``ruled`` is allow or block.

    Suffix statistics are out of fold: they leave out the rows of hosts in the row's own fold.  Half of the rows
    (by hash of the URL) train without any, as URLs of an unseen suffix are scored, so that the lexical features
    must decide there and no tree can rest on what the rules say of a suffix.

    Of more than ``sample`` rows those with the smallest URL hash are used.  Without rows, or with
    rows of one verdict, the model is that constant (without rows: allow)."""
    rows = (
        labelled.where(F.col("ruled").isNotNull())
        .withColumn("y", (F.col("ruled") == "block").cast("int"))
        .select(
            "y", "__suffix", F.xxhash64("__url").alias("h"), "__url",
            F.pmod(F.xxhash64(F.lit(2), "host"), F.lit(FOLDS)).alias("fold"), *[f"f_{f}" for f in LEXICAL],
        )
        .orderBy("h", "__url", "y")
        .limit(sample)
        .drop("__url")
    )
    rows = settle(rows, "url-sample")
    n, blocked = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    rate = blocked / n if n else 0.0
    if blocked in (0, n):
        return UrlModel(30.0 if n and blocked == n else -30.0, rate, None)
    folds = settle(
        rows.groupBy("__suffix", "fold").agg(F.sum("y").alias("own_y"), F.count("*").alias("own_n")), "url-folds"
    )
    sums = folds.groupBy("__suffix").agg(F.sum("own_y").alias("all_y"), F.sum("own_n").alias("all_n"))
    statistics = lambda y, n: [((y + PRIOR * rate) / (n + PRIOR)).alias("s_rate"), n.cast("double").alias("s_count")]
    suffixes = settle(sums.select("__suffix", *statistics(F.col("all_y"), F.col("all_n"))), "url-suffix")
    model = UrlModel(math.log(rate / (1 - rate)), rate, suffixes)
    others = folds.join(sums, "__suffix").select(
        "__suffix", "fold", *statistics(F.col("all_y") - F.col("own_y"), F.col("all_n") - F.col("own_n"))
    )
    seen = F.col("h") % 2 == 0
    rows = model.with_statistics(
        rows.join(others, ["__suffix", "fold"]).withColumns(
            {s: F.when(seen, F.col(s)) for s in ("s_rate", "s_count")}
        )
    )
    at = [i / BINS for i in range(1, BINS)]
    cuts = rows.agg(*[F.percentile(f"f_{f}", F.array(*map(F.lit, at))).alias(f) for f in FEATURES]).first()
    edges = [sorted(set(cuts[f])) for f in FEATURES]
    above = lambda f, e: F.array_size(F.filter(F.array(*map(F.lit, e)), lambda x: F.col(f"f_{f}") > x))
    binned = settle(
        rows.select("y", F.array(*[above(f, e) for f, e in zip(FEATURES, edges)]).alias("b"))
        .groupBy("b").agg(F.count("*").alias("n"), F.sum("y").alias("y")),
        "url-bins",
    )
    score = F.lit(model.base)
    in_bins = lambda s: F.get("b", F.lit(s.feature)) <= s.bin
    for _ in range(TREES):
        tree = _grow(binned.withColumn("m", score), in_bins, edges)
        if not isinstance(tree, Split):
            break
        model.trees.append(tree)
        score = score + _compiled(tree, in_bins)
    return model


def _grow(rows: DataFrame, in_bins, edges):
    """One tree, level by level, on the gradients of the log loss at margin ``m``."""
    p = 1 / (1 + F.exp(-F.col("m")))
    whole = lambda x: F.round(x * SCALE).cast("long")
    rows = rows.select(
        "b",
        whole(F.col("y") - F.col("n") * p).alias("g"),
        whole(F.col("n") * F.greatest(p * (1 - p), F.lit(1e-6))).alias("h"),
    )
    leaves: dict[tuple, object] = {(): None}
    for _ in range(DEPTH):
        tree = _nested(leaves, numbered := list(leaves))
        node = _compiled(tree, in_bins).cast("int")
        found: dict = {}
        histogram = (
            rows.select(node.alias("node"), "g", "h", F.posexplode("b").alias("f", "bin"))
            .groupBy("node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        )
        for r in histogram.collect():
            found.setdefault((r.node, r.f), {})[r.bin] = (r.g, r.h)
        new: dict[tuple, object] = {}
        for i, path in enumerate(numbered):
            best = _best({f: h for (k, f), h in found.items() if k == i}, edges)
            if best is None:
                new[path] = leaves[path]
            else:
                feature, cut, left, right = best
                step = (feature, cut, edges[feature][cut])
                new[(*path, (step, True))] = left
                new[(*path, (step, False))] = right
        leaves = new
    if len(leaves) == 1:
        return 0.0
    return _nested(leaves, None)


def _best(histograms: dict, edges):
    """The split of highest gain, as feature, bin and both leaf values."""
    best, top = None, 1e-3
    gain = lambda g, h: g * g / (h + 1.0)
    for f in sorted(histograms):
        bins = histograms[f]
        g = sum(x for x, _ in bins.values()) / SCALE
        h = sum(x for _, x in bins.values()) / SCALE
        gl = hl = 0.0
        for cut in range(len(edges[f])):
            dg, dh = bins.get(cut, (0, 0))
            gl, hl = gl + dg / SCALE, hl + dh / SCALE
            better = gain(gl, hl) + gain(g - gl, h - hl) - gain(g, h)
            if better > top and 0 < hl < h:
                leaf = lambda a, b: RATE * max(-4.0, min(4.0, a / (b + 1.0)))
                best, top = (f, cut, leaf(gl, hl), leaf(g - gl, h - hl)), better
    return best


def _nested(leaves: dict, numbered):
    """The leaves, keyed by their steps from the root, as a tree of splits; with
    ``numbered``, each leaf is its number there."""

    def build(prefix):
        if prefix in leaves:
            return float(numbered.index(prefix)) if numbered is not None else leaves[prefix] or 0.0
        step = next(p[len(prefix)][0] for p in leaves if p[: len(prefix)] == prefix)
        return Split(*step, build((*prefix, (step, True))), build((*prefix, (step, False))))

    return build(())


def judged(df: DataFrame, keep: list[str], rules: Sequence[UrlRule], url: str = "url", sample: int = SAMPLE) -> DataFrame:
    """The ``keep`` columns and ``host, path, rule, verdict, block_score`` (0 to 1; null where a
    rule decides), one row per row.

    Null URLs and such without ``://`` have empty host and path, fit no rule and are scored
    like others.  Repeated rows get the same verdict; columns besides ``keep`` are dropped."""
    rows = with_features(df, keep, url, rules)
    model = fit(rows, sample)
    rows = model.joined(rows)
    score = F.when(F.col("rule").isNull(), 1 / (1 + F.exp(-model.margin())))
    return rows.select(
        *keep, "host", "path", "rule",
        F.coalesce("ruled", F.when(score > 0.5, "block").otherwise("allow")).alias("verdict"),
        score.alias("block_score"),
    )
