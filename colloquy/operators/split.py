"""Exact, seeded train/validation/test split."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.operators import cuts

HASH_BITS = 60


def _check(ratios: dict[str, float]):
    total = sum(ratios.values())
    if abs(total - 1.0) > 0.01:
        raise ValueError(f"the shares of all splits together are {total}, not 1")


def _order(key: str, seed: int) -> tuple[Column, list[Column]]:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    number = F.conv(F.left(digest, F.lit(HASH_BITS // 4)), 16, 10).cast("long")
    return number, [digest, F.col(key)]


def exact_split(
    df: DataFrame,
    key: str = "example_id",
    ratios: dict[str, float] | None = None,
    seed: int = fixed.SPLIT_SEED,
) -> DataFrame:
    """Add ``split``.  Rows are ordered by a seeded hash of their unique key; the
    first ``int(n * train)`` are train, the next ``int(n * validation)`` validation,
    the rest test.  The hashes are written once; all cut points are searched for together, by counting; labelling
    a row then compares its own hash with them, so rows are neither sorted nor moved."""
    ratios = ratios or fixed.SPLIT_RATIOS
    _check(ratios)
    names = list(ratios)
    number, ties = _order(key, seed)
    rows = cuts.numbered(df, number, ties)
    known = cuts.totals(rows, [0])
    n = known[0][0] if known else 0
    ends, upto = {}, 0
    for name in names[:-1]:
        size = int(n * ratios[name])
        upto += size
        if size:
            ends[name] = upto
    found = cuts.of_ranks(rows, {0: list(ends.values())}, known)
    label = None
    for name, end in ends.items():
        cut = found.get((0, end))
        inside = F.lit(True) if cut is None else cuts.not_after(number, ties, cut)
        label = F.when(inside, F.lit(name)) if label is None else label.when(inside, F.lit(name))
    rest = F.lit(names[-1])
    return df.withColumn("split", rest if label is None else label.otherwise(rest))


def split_summary(split: DataFrame) -> DataFrame:
    """Rows and percent per split; the window sees one row per split."""
    counts = split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    every_split = Window.partitionBy(F.lit(0))
    return counts.select(
        "split", "n", (F.col("n") * 100.0 / F.sum("n").over(every_split)).alias("percent")
    )
