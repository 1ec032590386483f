"""Mixing sources to target weights on a time-varying curriculum.

A source's documents form a stream of words.  The source's demand is its target; its schedule
says how that demand spreads over training time 0 to 1.  The stream is passed over again until
the demand is met, and a document's training position is the time at which the cumulative
demand reaches the middle of the document.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.words import word_count
from colloquy.operators.lineage import settle

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix per word of the input, and of a source's target per word of the source.
BUDGET = 1.5
MOST = 2
#: Weight over training time at knots (time, weight), linear between, one per weight: the
#: first kind of source fades, the second stays, the third grows.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)
#: A source's stream is summed in so many ranges of its shuffled order.
RANGE_BITS = 16


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget=BUDGET, most=MOST) -> DataFrame:
    """``source, source_size, kind, target`` from ``source, source_size``, one row a source.

    Targets share ``budget`` times all sizes by weight, but stop at ``most`` times the source's
    size; the excess goes to the others by weight.  With sources in the order of size
    per weight, those up to some place stop and the others get the same words per weight."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    kind = (F.row_number().over(order) - 1) % len(weights)
    rows = sizes.select("source", "source_size", kind.cast("int").alias("kind"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1)
    rows = rows.withColumn("w", weight).withColumn("top", F.lit(float(most)) * F.col("source_size"))
    rows = rows.withColumn("turn", F.col("top") / F.col("w"))
    steps = Window.orderBy("turn", F.col("source").asc_nulls_last())
    before = steps.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    stopped, weighed = F.coalesce(F.sum("top").over(before), F.lit(0.0)), F.coalesce(F.sum("w").over(before), F.lit(0.0))
    words = F.lit(float(budget)) * F.sum("source_size").over(everything)
    rows = rows.withColumn("level", (words - stopped) / (F.sum("w").over(everything) - weighed))
    rows = rows.withColumn("step", F.row_number().over(steps))
    first = F.min_by("level", F.when(F.col("level") <= F.col("turn"), F.col("step"))).over(everything)
    return rows.withColumn("flat", first).select(
        "source", "source_size", "kind",
        F.when(F.col("flat").isNull(), F.col("top")).otherwise(F.least("top", F.col("flat") * F.col("w"))).alias("target"),
    )


def schedule_time(share: Column, knots) -> Column:
    """The time at which the integral of a piecewise linear weight reaches ``share`` of the whole."""
    pieces, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        pieces.append((total, t0, w0, (w1 - w0) / (t1 - t0)))
        total += (t1 - t0) * (w0 + w1) / 2
    need, out = share * F.lit(total), None
    for start, t0, w0, slope in pieces:
        rest = need - F.lit(start)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * rest))
        time = F.lit(t0) + F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / (F.lit(w0) + root))
        out = time if out is None else F.when(need >= F.lit(start), time).otherwise(out)
    return F.least(F.lit(1.0), out)


def mixed(
    df: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", source: str = "source",
    seed: int = 6, weights=WEIGHTS, schedules=SCHEDULES, budget=BUDGET, most=MOST,
) -> DataFrame:
    """The ``keep`` columns and ``size, source_size, target, taken, copies, position, position2, positions``,
    in the order of ``position``.

    ``copies`` is how often the mix takes the document (0 to ``most``), ``taken``
    its words so taken, ``positions`` the training times of the copies, ``position`` and ``position2`` the first two
    (null: none).  Documents stand in a seeded shuffled order within their source, so reruns agree.
    Null texts have no words; null sources form one source; repeated rows and keys are rows of their
    own.  A source's running sum is taken over ranges of the order and then inside each
    range, so that a source with most rows is spread like any other.  An empty table gives an
    empty result."""
    base = settle(_stream(df, keep, key, text, source, seed), "mix")
    out = _placed(base, weights, schedules, budget, most).select(
        *[F.col(_own(c)).alias(c) for c in keep],
        "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies", F.get("positions", F.lit(0)).alias("position"), F.get("positions", F.lit(1)).alias("position2"), "positions",
    )
    return out.orderBy(F.col("position").asc_nulls_last(), *keep)


def _own(column: str) -> str:
    return f"__{column}"


def _stream(df: DataFrame, keep: list[str], key: str, text: str, source: str, seed: int) -> DataFrame:
    """The rows with their source, size and place in the shuffled order.  The source is in a struct, so that
    a null source equals itself."""
    return df.select(
        *[F.col(c).alias(_own(c)) for c in keep],
        F.struct(F.col(source).alias("source")).alias("of"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(key), F.xxhash64(text)).alias("h"),
        F.col(key).alias("k"),
        F.xxhash64(text).alias("tie"),
    ).withColumn("range", F.shiftright("h", 64 - RANGE_BITS))


def _placed(base: DataFrame, weights, schedules, budget, most) -> DataFrame:
    """``base`` with ``size, source_size, target, copies, positions``.

    All that is known of a source goes into the table of its ranges first, so that rows are joined once, on the
    columns by which the running sum has already dealt them out."""
    ranges = settle(base.groupBy("of", "range").agg(F.sum("size").alias("range_size")), "mix-ranges")
    so_far = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("of").agg(F.sum("range_size").alias("source_size"))
    targets = source_targets(sizes.select("of.source", "source_size"), weights, budget, most)
    targets = targets.withColumn("of", F.struct("source")).drop("source")
    ranges = ranges.withColumn("from", F.coalesce(F.sum("range_size").over(so_far), F.lit(0)))
    ranges = ranges.join(targets, "of").drop("range_size")
    order = Window.partitionBy("of", "range").orderBy("h", "k", "size", "tie")
    inside = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        base.withColumn("in_range", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(ranges, ["of", "range"])
        .withColumn("middle", F.col("from") + F.col("in_range") + F.col("size") / 2)
    )
    # Copy c of a document stands as far on as c whole sources; no target is above ``most`` of them.
    places = [F.col("middle") + c * F.col("source_size") for c in range(math.ceil(most))]
    copies = sum(((at < F.col("target")).cast("int") for at in places), F.lit(0))
    when = lambda at: F.coalesce(
        *[F.when(F.col("kind") == i, schedule_time(at / F.col("target"), k)) for i, k in enumerate(schedules)]
    )
    return rows.withColumn("copies", copies).withColumns(
        {
            "positions": F.filter(F.array(*[F.when(F.col("copies") > c, when(at)) for c, at in enumerate(places)]), lambda t: t.isNotNull())
        }
    )


def in_training_order(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 6,
    weights=WEIGHTS, schedules=SCHEDULES, budget=BUDGET, most=MOST,
) -> DataFrame:
    """All columns of ``df``, each row as often as the mix takes it, sorted by training position; the cases
    are those of ``mixed``.

    ``df`` is read twice, for the sizes and for the rows, so it had best be a stored table.  Texts move with the
    running sum and with the sort; no further copy of them is written."""
    base = _stream(df, df.columns, key, text, source, seed)
    rows = _placed(base, weights, schedules, budget, most)
    own = [F.col(_own(c)).alias(c) for c in df.columns]
    taken = rows.select(*[_own(c) for c in df.columns], "k", "tie", F.explode("positions").alias("time"))
    return taken.orderBy("time", "k", "tie").select(*own)
