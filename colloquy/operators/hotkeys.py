"""Ordered work within keys that may be too large for one task.

Ranks and running values of a key normally bring its rows into one task.  Where some key has more than
``CHUNK_ROWS`` rows, the table is sorted by key and order instead, dealt by ranges of both, so that a large key is cut
along its order into chunks of about that size; results per chunk are then combined over the chunks before.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.operators.lineage import settle

CHUNK_ROWS = 1_000_000


def large_keys(df: DataFrame, key: str, chunk_rows: int = CHUNK_ROWS) -> int:
    """Rows of the table if some key has more than ``chunk_rows`` of them, else 0."""
    total = df.count()
    if total <= chunk_rows:
        return 0
    large = df.groupBy(key).count().where(F.col("count") > chunk_rows)
    return 0 if large.isEmpty() else total


def add_chunks(df: DataFrame, key: str, order: list[str], chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, bool]:
    """Add ``chunk`` and ``at``: rows of a key are in order by ``chunk``, then ``at``, and a chunk has about ``chunk_rows`` rows at
    most.  Ranges are cut on key and the whole order, so a key of one time stamp is cut as well, if a later column tells its rows apart.
    The second result tells whether any key was cut; if not, the rows are as they were, in chunk 0."""
    total = large_keys(df, key, chunk_rows)
    if not total:
        return df.withColumns({"chunk": F.lit(0).cast("long"), "at": F.lit(0).cast("long")}), False
    parts = -(-total // chunk_rows) + 1
    dealt = df.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
    placed = settle(dealt.withColumn("at", F.monotonically_increasing_id()), "in-order")
    # The number holds the partition above 33 bits of the row's place in it.
    return placed.withColumn("chunk", F.shiftright("at", 33)), True


def earlier_chunks(chunked: DataFrame, key: str, aggregates: dict[str, Column], combine) -> DataFrame:
    """Per ``(key, chunk)`` the combination of ``aggregates`` over all earlier chunks of the key: all keys together have no more
    rows here than there are keys and chunks."""
    per_chunk = chunked.groupBy(key, "chunk").agg(*[c.alias(n) for n, c in aggregates.items()])
    before = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    found = per_chunk.select(F.col(key).alias("_key"), F.col("chunk").alias("_chunk"), *[combine(n).over(before).alias(n) for n in aggregates])
    return settle(found, "earlier")


def with_earlier(chunked: DataFrame, key: str, earlier: DataFrame) -> DataFrame:
    """The rows with what ``earlier_chunks`` found for their chunk; a null key is a key like any other."""
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("chunk") == F.col("_chunk"))
    return chunked.join(earlier, same, "left").drop("_key", "_chunk")


def add_position(
    df: DataFrame, key: str, order: list[str], name: str = "position",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Number the rows of each key from 1 in the given order."""
    chunked, cut = add_chunks(df, key, order, chunk_rows)
    if not cut:
        within = F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long")
        return chunked.withColumn(name, within).drop("chunk", "at")
    # Rows of a chunk and key follow each other, so only its first place and the rows before it are needed.
    first = chunked.groupBy(key, "chunk").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1
    offsets = settle(first.select(F.col(key).alias("_key"), F.col("chunk").alias("_chunk"), offset.alias("_offset")), "offsets")
    return with_earlier(chunked, key, offsets).withColumn(name, F.col("at") + F.col("_offset")).drop("chunk", "at", "_offset")
