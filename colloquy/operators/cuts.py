"""Keys of given ranks of a table, found by counting instead of sorting."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.operators.lineage import settle

BUCKETS = 4_096
FEW_ROWS = 10_000


def numbered(df: DataFrame, number: Column, ties: list[Column] = [], group: Column | None = None) -> DataFrame:
    """``group, number, tie0, tie1, ...`` written once, for any number of searches."""
    group = F.lit(0) if group is None else group
    return settle(df.select(group.alias("group"), number.alias("number"), *[t.alias(f"tie{i}") for i, t in enumerate(ties)]), "ranks")


def totals(rows: DataFrame, groups: list) -> dict:
    """Rows, least and largest number of each group asked for that has any."""
    found = rows.where(F.col("group").isin(groups) & F.col("number").isNotNull()).groupBy("group")
    return {r[0]: tuple(r[1:]) for r in found.agg(F.count("*"), F.min("number"), F.max("number")).collect()}


def of_ranks(rows: DataFrame, ranks: dict[object, list[int]], known: dict | None = None) -> dict[tuple, tuple]:
    """``(group, rank)`` to the ``(number, *ties)`` of that rank (from 1) in its group, in the order of number and ties;
    ranks a group does not have are missing.  ``rows`` is a table of ``numbered``; groups and ranks are a
    bounded list of the caller's.

    Each pass counts the rows of all open ranges in at most ``BUCKETS`` steps each and goes on, for every rank, in the
    step that holds it, until few rows are left to sort.  Only counts and the rows found reach the driver."""
    known = totals(rows, list(ranks)) if known is None else known
    wanted = {}  # (group, rank) -> rank inside, first number, number after the last, rows inside
    for group, of in ranks.items():
        n, low, high = known.get(group, (0, 0, 0))
        wanted |= {(group, k): (k, low, high + 1, n) for k in of if 1 <= k <= n}

    def inside(ranges):
        long = lambda x: F.lit(x).cast("long")
        table = F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(g).alias("g"), long(low).alias("low"), long(high).alias("high"), long(-(-(high - low) // BUCKETS)).alias("width"))
            for i, (g, low, high) in enumerate(ranges)
        ])  # one per rank asked for at most
        here = lambda r: (F.col("group") == r["g"]) & (F.col("number") >= r["low"]) & (F.col("number") < r["high"])
        return rows.select("*", F.inline(F.filter(table, here)))

    while ranges := sorted({(g, low, high) for (g, _), (_, low, high, n) in wanted.items() if n > FEW_ROWS and high - low > 1}, key=str):
        steps = inside(ranges).groupBy("i", F.expr("(number - low) div width").alias("b")).count().collect()
        for (group, rank), (k, low, high, n) in wanted.items():
            if (group, low, high) not in ranges:
                continue
            at, width = ranges.index((group, low, high)), -(-(high - low) // BUCKETS)
            for _, b, n in sorted(s for s in steps if s[0] == at):
                if k <= n:
                    break
                k -= n
            wanted[group, rank] = k, low + b * width, min(high, low + (b + 1) * width), n

    order = [c for c in rows.columns if c != "group"]
    few = {key: w for key, w in wanted.items() if w[3] <= FEW_ROWS}
    out = {}
    if few:
        ranges = sorted({(key[0], low, high) for key, (_, low, high, _) in few.items()}, key=str)
        placed = inside(ranges).withColumn("k", F.row_number().over(Window.partitionBy("i").orderBy(*order)))
        asked = [(ranges.index((key[0], low, high)), k) for key, (k, low, high, _) in few.items()]
        found = {(r.i, r.k): tuple(r[c] for c in order) for r in placed.where(F.concat_ws(":", "i", "k").isin([f"{i}:{k}" for i, k in asked])).collect()}
        out = {key: found[at] for key, at in zip(few, asked)}
    for (group, rank), (k, low, _, n) in wanted.items():
        if n > FEW_ROWS:  # one number that very many rows share
            same = rows.where((F.col("group") == F.lit(group)) & (F.col("number") == low))
            out[group, rank] = tuple(same.select(*order).orderBy(*order).offset(k - 1).limit(1).collect()[0])
    return out


def kth_smallest(df: DataFrame, number: Column, ties: list[Column], k: int, low: int, high: int):
    """The ``(number, *ties)`` tuple of rank ``k`` (from 1) among rows whose
    ``number`` lies in ``[low, high)``; None when there are fewer rows."""
    return of_ranks(numbered(df.where((number >= low) & (number < high)), number, ties), {0: [k]}).get((0, k))


def not_after(number: Column, ties: list[Column], cut: tuple) -> Column:
    """Whether ``(number, *ties)`` is at or before ``cut``."""
    values = [number, *ties]
    condition = values[-1] <= F.lit(cut[-1])
    for value, bound in reversed(list(zip(values[:-1], cut[:-1]))):
        condition = (value < F.lit(bound)) | ((value == F.lit(bound)) & condition)
    return condition


def first_of_each(df: DataFrame, group: str, number: str, counts: dict[object, int]) -> DataFrame:
    """The ``counts[group]`` rows of smallest ``number`` of each group, all where it has fewer; numbers are unique in a
    group.  Groups not asked for give no rows.  No group is sorted or brought together: its cut is found by counting."""
    counts = {g: n for g, n in counts.items() if n > 0}
    if not counts:
        return df.limit(0)
    asked = df.where(F.col(group).isin(list(counts)))
    found = of_ranks(numbered(asked, F.col(number), group=F.col(group)), {g: [n] for g, n in counts.items()})
    over = [(F.col(group) == F.lit(g)) & (F.col(number) > F.lit(cut[0])) for (g, _), cut in found.items()]
    for condition in over:
        asked = asked.where(~condition)
    return asked
