"""Nearest neighbours by inner product with learned partitions.

A neighbour graph of a sample is cut into balanced parts; a softmax classifier learns which part a vector
belongs to and files every vector; a query goes to the parts that the classifier holds most
probable and is ranked exactly against all vectors there.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.operators.lineage import settle

#: Vectors that graph, parts and classifier are fitted on at most: those of the smallest hashes.
SAMPLE = 8_192
#: Vectors a part is meant to hold, and parts at most (a share of the sample).
PART, PARTS = 1_000, 256
NEIGHBOURS, SLACK = 10, 1.1
#: A query goes to as many parts as reach this share of its true neighbours in the sample.
REACHED = 0.95
#: Parts to begin with; doubling them must lower the share of parts visited to this share of it.
FIRST_PARTS, PAYS = 8, 0.8
#: Vectors of a part compared in one task, and queries.
BLOCK, QUERIES = 16_384, 2_048


@dataclass
class Router:
    """Class weights of the softmax; ``probes`` parts serve a query."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def parts(self, x: np.ndarray) -> np.ndarray:
        return self.scores(x).argmax(1)

    def probed(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, : self.probes]


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest others of each row, in blocks."""
    out = []
    for a in range(0, len(x), 256):
        s = x[a : a + 256] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out.append(np.argpartition(-s, k - 1, axis=1)[:, :k].copy())
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 8) -> np.ndarray:
    """Parts of about equal size with few neighbour links across: halves by random direction to begin with, then
    vertices move to the part of most of their neighbours while it has room."""
    rng = np.random.default_rng(seed)
    label = np.zeros(len(x), np.int64)
    todo, done = [(np.arange(len(x)), parts)], 0
    while todo:
        rows, n = todo.pop()
        if n == 1:
            label[rows] = done
            done += 1
            continue
        centred = x[rows] - x[rows].mean(0)
        way = rng.standard_normal(x.shape[1])
        for _ in range(6):
            way = centred.T @ (centred @ way)
            way /= np.linalg.norm(way) or 1.0
        order = rows[np.argsort(centred @ way, kind="stable")]
        cut = len(rows) * (n // 2) // n
        todo += [(order[:cut], n // 2), (order[cut:], n - n // 2)]
    both = [list(g) for g in graph]
    for i, near in enumerate(graph):
        for j in near:
            both[j].append(i)
    room = int(np.ceil(SLACK * len(x) / parts))
    size = np.bincount(label, minlength=parts)
    for _ in range(8):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(label[both[i]], minlength=parts)
            votes[size >= room] = -1
            votes[label[i]] = (label[both[i]] == label[i]).sum()
            to = int(votes.argmax())
            if votes[to] > votes[label[i]]:
                size[label[i]] -= 1
                size[to] += 1
                label[i] = to
                moved += 1
        if moved < len(x) // 100:
            break
    return label


def softmax_fit(x: np.ndarray, label: np.ndarray, parts: int, steps: int = 150, seed: int = 8):
    """Weights and bias by Adam on minibatches of the cross entropy."""
    rng = np.random.default_rng(seed)
    scale = 1.0 / (x.std() + 1e-12)
    w = np.zeros((x.shape[1] + 1, parts))
    m, v = np.zeros_like(w), np.zeros_like(w)
    data = np.hstack([x * scale, np.ones((len(x), 1))])
    size = min(len(x), 1024)
    for t in range(1, steps + 1):
        rows = rng.choice(len(x), size, replace=False)
        z = data[rows] @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(size), label[rows]] -= 1
        g = data[rows].T @ p / size + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w[:-1] * scale, w[-1]


def fit_router(x: np.ndarray, most: int) -> Router:
    """Graph, parts and classifier on the sample.  Parts are doubled, up to ``most``, as long as
    that lowers the share of the parts that a query must go to by ``PAYS``: where vectors have no
    neighbourhoods to learn, more parts would only mean more visits."""
    most = max(1, min(most, len(x) // 32))
    if most == 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), 1)
    graph = neighbour_graph(x, min(NEIGHBOURS, len(x) - 1))
    parts = min(FIRST_PARTS, most)
    router = _fitted(x, graph, parts)
    while 2 * parts <= most:
        finer = _fitted(x, graph, 2 * parts)
        if finer.probes / (2 * parts) > PAYS * router.probes / parts:
            break
        router, parts = finer, 2 * parts
    return router


def _fitted(x: np.ndarray, graph: np.ndarray, parts: int) -> Router:
    """The classifier for so many parts, and the probes that reach ``REACHED`` of the sample's own
    neighbour links."""
    router = Router(*softmax_fit(x, balanced_parts(x, graph, parts), parts), parts)
    order = np.argsort(-router.scores(x), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], 1)
    needed = np.take_along_axis(place, order[:, 0][graph], 1).ravel()
    router.probes = int(np.quantile(needed, REACHED)) + 1
    return router


def vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` (array of double) of the vectors that take part: key not null, not null, not zero, all
    components finite, of the commonest length (of equally common ones the shortest).  A repeated key
    with an equal vector counts once."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(key).alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & fine & F.exists("v", lambda x: x != 0)
    )
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n").first()
    return rows.where(F.size("v") == (size[0] if size else 0)).distinct()


def _routed(df: DataFrame, router: Router, all_parts: bool) -> DataFrame:
    """A row for each part a vector is filed in (one) or goes to as a query."""
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType())])
    at = df.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(at))
            parts = router.probed(x) if all_parts else router.parts(x)[:, None]
            rows = pa.array(np.repeat(np.arange(len(x)), parts.shape[1]))
            columns = [c.take(rows) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(parts.ravel(), pa.int32())], schema.names)

    return df.mapInArrow(run, schema)


def _matrix(column) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64)


HITS = T.StructType(
    [T.StructField("q", T.LongType()), T.StructField("c", T.LongType()), T.StructField("score", T.DoubleType())]
)


def _nearest(k: int):
    """The ``k`` best classes of a block for each query, ties to the smaller class."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            left = left.sort_by("c")
            c, x = left["c"].to_numpy(), _matrix(left["v"].combine_chunks())
            q, y = right["q"].to_numpy(), _matrix(right["v"].combine_chunks())
            for a in range(0, len(q), 256):
                s = y[a : a + 256] @ x.T
                best = np.argsort(-s, axis=1, kind="stable")[:, :k]
                out[0].append(np.repeat(q[a : a + 256], best.shape[1]))
                out[1].append(c[best].ravel())
                out[2].append(np.take_along_axis(s, best, 1).ravel())
        kinds = (np.int64, np.int64, np.float64)
        arrays = [pa.array(np.concatenate(o) if o else np.zeros(0, t)) for o, t in zip(out, kinds)]
        return pa.Table.from_arrays(arrays, names=["q", "c", "score"])

    return run


def nearest(df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``is_query`` (on ``id``) holds, its ``k`` nearest
    found among all rows but those of its own key.

    Equal vectors are one class, named by its smallest key, and are compared once; a class
    lends at most ``k`` + 1 keys, its smallest, as no result can hold more.  Parts are cut into
    blocks and their queries into bundles by hash, so that no task grows with a part.  Scores are the
    inner product in double precision.  Keys are longs; an empty table gives an empty result."""
    rows = settle(vectors(df, key, vector), "vectors")
    classes = settle(rows.groupBy("v").agg(F.min("id").alias("c")), "vector-classes")
    n = classes.count()
    members = settle(rows.join(classes, "v").select("id", "c"), "vector-members")
    kept = members.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy("id"))).where(F.col("r") <= k + 1).drop("r")
    chosen = classes.orderBy(F.xxhash64(F.lit(8), "c"), "c").limit(sample).select("v").toArrow()
    x = _matrix(chosen["v"].combine_chunks()) if n else np.zeros((0, 1))
    router = fit_router(x, min(PARTS, -(-n // PART)))
    filed = settle(_routed(classes, router, False), "vector-index")
    asking = members.where(is_query).select("c").distinct().join(classes, "c").select(F.col("c").alias("q"), "v")
    sent = settle(_routed(asking, router, True), "vector-queries")
    blocks = dict(filed.groupBy("part").count().collect())
    bundles = dict(sent.groupBy("part").count().collect())
    count = lambda found, size: F.coalesce(
        F.get(F.array(*[F.lit(-(-found.get(p, 0) // size)) for p in range(router.bias.size)]), F.col("part")), F.lit(1)
    )
    all_of = lambda found, size: F.explode(F.sequence(F.lit(0), F.greatest(count(found, size) - 1, F.lit(0))))
    one_of = lambda found, size, by: F.pmod(F.xxhash64(by), F.greatest(count(found, size), F.lit(1)))
    left = filed.select("c", "v", "part", one_of(blocks, BLOCK, "c").cast("int").alias("block"), all_of(bundles, QUERIES).alias("bundle"))
    right = sent.select("q", "v", "part", all_of(blocks, BLOCK).alias("block"), one_of(bundles, QUERIES, "q").cast("int").alias("bundle"))
    at = ["part", "block", "bundle"]
    hits = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(_nearest(k + 1), HITS)
    top = lambda d, by, order, most: d.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("r") <= most)
    best = settle(top(hits, "q", [F.desc("score"), "c"], k + 1).drop("r"), "vector-hits")
    near = top(best.join(kept, "c").select("q", "id", "score"), "q", [F.desc("score"), "id"], k + 1).drop("r")
    asked = members.where(is_query).select(F.col("id").alias("query_id"), F.col("c").alias("q"))
    found = asked.join(near, "q").where(F.col("id") != F.col("query_id"))
    ranked = top(found, "query_id", [F.desc("score"), "id"], k)
    return ranked.select("query_id", F.col("r").alias("rank"), F.col("id").alias("vec_id"), "score")
