"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.operators.lineage import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` (longs, not null): the smallest node reachable.

    Each round hangs the larger neighbours of a node, then the smaller ones, under the smallest node
    around it, and stores the edges, until all hang under a root; rounds grow with
    the logarithm of the longest path.  Sums per node are aggregated before they move, and a node's
    neighbours are joined to its minimum, never collected.  No edges give no rows."""
    now = settle(_tidy(edges.select("a", "b")), "edges")
    while True:
        wide = _hang(now.union(now.select(F.col("b"), F.col("a"))), larger=True)
        now = settle(_tidy(_hang(wide, larger=False)), "edges")
        if _stars(now):
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select("b", "b").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs under one node, which hangs under none."""
    once = edges.groupBy("a").count().where("count > 1").isEmpty()
    return once and edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def _tidy(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller node."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _hang(edges: DataFrame, larger: bool) -> DataFrame:
    """``larger``: edges in both directions; each larger neighbour of a node goes under the smallest node
    around.  Else: edges downward; node and smaller neighbours go under the smallest."""
    lowest = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    joined = edges.join(lowest, "a")
    if larger:
        return joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b")
    own = lowest.select("a", F.col("low").alias("b"))
    return joined.where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b")).union(own)
