"""SimHash near-duplicates with covering locality-sensitive hashing.

For radius r every bit position gets a vector of r + 1 bits.  There is a table for each
nonzero vector v; its mask keeps the positions whose vector has an odd product with v.  Up to r differing
positions have vectors that leave some v orthogonal to all of them, so every pair within the radius
agrees on all kept bits of some table: no pair is missed.
"""

import random

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.batches import map_rows
from colloquy.llm.components import components
from colloquy.operators.lineage import settle

BITS = 64
#: Shingle width, hash seed and radius of the fingerprints.
WIDTH, SEED, RADIUS = 4, 42, 4
#: Members up to which a bucket is compared in one task, all with all; larger buckets go
#: through shared midpoints.  Both ways find every link.
BUCKET = 2_048

FINGERPRINT = T.StructType([T.StructField("fp", T.LongType())])


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The SimHash of a text as a signed 64-bit number.  A-Z count as a-z; a text of fewer words
    than ``width`` is one shingle; without words it is zero."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    stops = (ends - 1).tolist()[width - 1 :] or [len(line)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
    counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, keep: list[str], text: str = "text", width: int = WIDTH) -> DataFrame:
    """``keep`` columns and ``fp``, of whole texts; null texts are empty."""
    return map_rows(df, text, keep, FINGERPRINT, lambda: lambda x: [(fingerprint(x, width),)])


def masks(radius: int = RADIUS, bits: int = BITS, seed: int = 3) -> list[int]:
    """The covering masks as unsigned numbers, 2 ** (radius + 1) - 1 of them.  Vectors are dealt
    evenly in a seeded order, all nonzero, so that every mask keeps about half the bits."""
    size = (1 << (radius + 1)) - 1
    vectors = [1 + i % size for i in range(bits)]
    random.Random(seed).shuffle(vectors)
    odd = lambda x: x.bit_count() & 1
    return [sum(1 << i for i, p in enumerate(vectors) if odd(p & v)) for v in range(1, size + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect all points linked within the radius, at most one fewer than points.
    A breadth-first walk compares one point with those not reached yet."""
    rest, links = points, []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count((rest ^ at).view(np.uint64)) <= radius
            links += [(int(at), int(x)) for x in rest[near]]
            queue += list(rest[near])
            rest = rest[~near]
    return links


LINKS = T.ArrayType(
    T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
)


def _linker(radius: int):
    @F.pandas_udf(LINKS)
    def links(members):
        import pandas as pd

        return pd.Series([_forest(np.asarray(m, np.int64), radius) for m in members])

    return links


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` between different fingerprints of ``fp`` at most ``radius`` bits apart: enough
    to connect every two that are linked by any chain.

    One key per table and distinct fingerprint, a hash of both (keys that meet by chance only
    cost a comparison).  Buckets of one member are dropped by an
    aggregate that runs before the shuffle; those of two are a pair; up to ``bucket`` members are compared
    in one task; members of larger ones meet in the points halfway between them, of which each has
    as many as there are ways to change ``radius`` / 2 bits, whatever the bucket's size."""
    fps = settle(fps.select("fp").where("fp is not null").distinct(), "fingerprints")
    masked = [F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long"))) for t, m in enumerate(masks(radius))]
    keys = fps.select("fp", F.explode(F.array(*masked)).alias("k"))
    size = keys.groupBy("k").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    size = settle(size, "buckets")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = size.where("n = 2").where(close).select("a", "b")
    found = settle(keys.join(size.where("n > 2").select("k", "n"), "k"), "members")
    inside = (
        found.where(F.col("n") <= bucket).groupBy("k").agg(F.collect_list("fp").alias("members"))
        .select(F.explode(_linker(radius)("members")).alias("x")).select("x.a", "x.b")
    )
    out = pairs.union(inside)
    if not (crowd := found.where(F.col("n") > bucket)).isEmpty():
        out = out.union(_by_midpoints(crowd.select("fp").distinct(), radius))
    return out.where("a <> b")


def _around(fps: DataFrame, flips: int) -> DataFrame:
    """``fp, p``: all points at most so many bits from each fingerprint, once each."""
    points = fps.select("fp", F.col("fp").alias("p"), F.lit(0).alias("i"))
    for _ in range(flips):
        flip = F.when(F.col("j") < BITS, F.expr("shiftleft(1L, j)")).otherwise(F.lit(0).cast("long"))
        points = points.select(
            "fp", "p", F.explode(F.sequence(F.col("i"), F.lit(BITS))).alias("j")
        ).select(
            "fp", F.col("p").bitwiseXOR(flip).alias("p"), F.least(F.col("j") + 1, F.lit(BITS)).alias("i")
        )
    return points.select("fp", "p")


def _by_midpoints(fps: DataFrame, radius: int) -> DataFrame:
    """Two fingerprints within the radius share a point half the radius, rounded down, from one and the rest from the
    other.  Fingerprints so near to a point are within the radius of each other, and of those at the rest."""
    near = _around(fps, radius // 2)
    far = _around(fps, radius - radius // 2) if radius % 2 else near
    lowest = near.groupBy("p").agg(F.min("fp").alias("low"))
    met = far.join(lowest, "p").where("fp <> low")
    return met.select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()


def grouped(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
    radius: int = RADIUS, bucket: int = BUCKET,
) -> DataFrame:
    """``key, fp, component_id``, one row per row: the smallest key reachable over links of at
    most ``radius`` differing fingerprint bits.

    Rows without words (null and empty texts too) have fingerprint zero and are linked like any
    other.  Repeated rows and equal texts share a fingerprint and are one node.  A null key is
    the smallest only where its group has no other.  Other columns are dropped, whatever
    their names; an empty table gives an empty result."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = settle(fingerprints(rows, ["key"], width=width), "simhash")
    lowest = rows.groupBy("fp").agg(F.min("key").alias("low"))
    roots = components(links(rows, radius, bucket))
    linked = roots.join(lowest, F.col("node") == F.col("fp")).select("fp", "low", "root")
    lows = linked.groupBy("root").agg(F.min("low").alias("root_low"))
    linked = linked.join(lows, "root").select(F.col("fp").alias("f"), "root_low")
    nodes = lowest.join(linked, F.col("fp") == F.col("f"), "left").select(
        F.col("fp").alias("f"), F.coalesce("root_low", "low").alias("component_id")
    )
    return rows.join(nodes, F.col("fp") == F.col("f")).select(
        F.col("key").alias(key), "fp", "component_id"
    )


def candidates(texts: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """Of ``rid, text, digest``: the lowest ``rid`` of each fingerprint and digest, and pairs ``lo, hi`` of these for an exact
    check: the lowest of a fingerprint with its others, and the lowest of linked fingerprints with each other."""
    rows = settle(fingerprints(texts, ["rid", "digest"]), "simhash")
    first = settle(rows.groupBy("fp", "digest").agg(F.min("rid").alias("rid")).select("rid", "fp"), "simhash-firsts")
    lowest = first.groupBy("fp").agg(F.min("rid").alias("low"))
    inside = first.join(lowest, "fp").where("rid <> low").select(F.col("low").alias("lo"), F.col("rid").alias("hi"))
    pairs = links(first, radius, bucket)
    for end in ("a", "b"):
        pairs = pairs.join(lowest.select(F.col("fp").alias(end), F.col("low").alias(f"low_{end}")), end)
    across = pairs.select(F.least("low_a", "low_b").alias("lo"), F.greatest("low_a", "low_b").alias("hi"))
    return first.select("rid"), inside.union(across)


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All columns of the rows that stay: of each near-duplicate group the row with the smallest
    key; among rows of that key the first stored.  A row without a key stays only where no row
    of its group has one.  Keys are numbers or strings."""
    stored = settle(df.withColumn("__row", F.monotonically_increasing_id()), "simhash-rows")
    rank = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("__row").alias("row"))
    marked = grouped(stored.withColumn("__rank", rank), "__rank", text, **options)
    stay = marked.select(F.col("component_id")["row"].alias("__row")).distinct()
    return stored.join(stay, "__row", "left_semi").drop("__row")
