"""Hard negatives by exact integer scores from a residue number system.

Rows and anchors are dealt into blocks; each pair of an anchor group and a row block is one cell of a grid and is
scored in one task.  A cell multiplies the matrices modulo a few small primes in float32, where every sum stays below
2 ** 24 and is exact, and the signed scores come back by Chinese remaindering.  The number of
primes follows from the largest component, so no score is ever rounded.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.operators.lineage import settle

#: Odd primes below 256, largest first: a product of two balanced residues is at most 125 * 125.
PRIMES = [p for p in range(255, 2, -2) if all(p % q for q in range(3, 16, 2) if q < p)]
#: Components that float32 adds up exactly.
INNER = 1_024
#: Components of a block of rows or a group of anchors at most, and scores held at once.
BLOCK, HELD = 1 << 22, 1 << 21
#: A table of fewer than 64 full blocks is cut into 64, of so many rows at least.
BLOCKS, ROWS = 64, 2_048
NONE = np.iinfo(np.int64).min


def primes_for(bound: int) -> list[int]:
    """Primes enough to tell all integers from -bound to bound apart."""
    out, product = [], 1
    for p in PRIMES:
        out.append(p)
        product *= p
        if product > 2 * bound:
            return out
    raise ValueError("scores are too large")


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    x = np.remainder(x, p)
    return x - p * (x > p // 2)


def _residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [_balanced(vectors, p).astype(np.float32) for p in primes]


def _product(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The exact inner products of all rows of two matrices, given as residues."""
    out, modulus = None, 1
    for a, b, p in zip(left, right, primes):
        r = np.zeros((len(a), len(b)), np.int64)
        for k in range(0, a.shape[1], INNER):
            r += (a[:, k : k + INNER] @ b[:, k : k + INNER].T).astype(np.int64)
        if out is None:
            out = _balanced(r, p)
        else:
            out += _balanced((r - out) % p * pow(modulus, -1, p), p) * modulus
        modulus *= p
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices, as a test sees them."""
    top = lambda x: int(np.abs(x).max(initial=0))
    primes = primes_for(left.shape[1] * top(left) * top(right))
    return _product(_residues(left, primes), _residues(right, primes), primes)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors side by side; missing components are zero."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


class _Cell:
    """The rows of a cell by id, repeated rows once, and the scores of its anchors."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, width: int, primes: list[int]):
        self.primes = primes
        v, ids, labels = _matrix(rows.column("v").combine_chunks(), width), _numbers(rows, "id"), _numbers(rows, "label")
        order = np.argsort(ids, kind="stable")
        twins = np.flatnonzero(ids[order][1:] == ids[order][:-1])
        keep, seen = np.ones(len(order), bool), set()
        for at in np.union1d(twins, twins + 1):
            i = order[at]
            mark = (ids[i], labels[i], v[i].tobytes())
            keep[at] = mark not in seen
            seen.add(mark)
        order = order[keep]
        self.ids, self.labels = ids[order], labels[order]
        self.rows = _residues(v[order], primes)
        self.anchors = _residues(_matrix(anchors.column("v").combine_chunks(), width), primes)

    def scores(self, which: np.ndarray, among: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Anchors, a few at once, and their scores with the rows ``among``."""
        right = [r[among] for r in self.rows]
        step = max(1, HELD // max(1, len(among)))
        for first in range(0, len(which), step):
            part = which[first : first + step]
            yield part, _product([a[part] for a in self.anchors], right, self.primes)


def _first(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of each owner's first entries: highest score, then smallest id."""
    order = np.lexsort((ids, -score, owner))
    owner = owner[order]
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, int)
    place = np.arange(len(owner)) - np.repeat(start, np.diff(np.r_[start, len(owner)]))
    return order[place < most]


def _positives(anchors: pa.Table, rows: pa.Table, width: int, primes: list[int], most: int) -> pa.Table:
    """Each anchor's first rows of its own label in this cell."""
    cell = _Cell(anchors, rows, width, primes)
    number, own, label = (_numbers(anchors, c) for c in ("a", "anchor_id", "label"))
    out = [[], [], []]
    for one in np.unique(label):
        among = np.flatnonzero(cell.labels == one)
        ids = cell.ids[among]
        if not len(ids):
            continue
        for part, s in cell.scores(np.flatnonzero(label == one), among):
            low, high = np.searchsorted(ids, own[part]), np.searchsorted(ids, own[part], "right")
            for i in np.flatnonzero(high > low):
                s[i, low[i] : high[i]] = NONE
            floor = np.full(len(part), NONE)
            if len(ids) > most:
                floor = np.partition(s, len(ids) - most, axis=1)[:, len(ids) - most]
            who, which = np.nonzero((s >= floor[:, None]) & (s != NONE))
            got = _first(who, s[who, which], ids[which], most)
            for values, x in zip(out, (number[part][who[got]], ids[which[got]], s[who[got], which[got]])):
                values.append(x)
    return _table(["a", "id", "score"], out)


def _negatives(anchors: pa.Table, rows: pa.Table, width: int, primes: list[int], most: int, low: int, high: int) -> pa.Table:
    """For each anchor and positive the first rows of other labels within the window, in this cell."""
    cell = _Cell(anchors, rows, width, primes)
    number, label = _numbers(anchors, "a"), _numbers(anchors, "label")
    positives = anchors.column("positives").to_pylist()
    slots = max(map(len, positives), default=0)
    least, most_score = np.full((len(number), slots), 1, np.int64), np.zeros((len(number), slots), np.int64)
    for i, found in enumerate(positives):
        for j, p in enumerate(found):
            least[i, j], most_score[i, j] = -(-low * p["score"] // high), p["score"]
    out = [[] for _ in range(4)]
    everyone = np.arange(len(cell.ids))
    for part, s in cell.scores(np.arange(len(number)), everyone):
        floor, top = least[part].min(1), most_score[part].max(1)
        near = (s >= floor[:, None]) & (s <= top[:, None]) & (cell.labels[None, :] != label[part][:, None])
        who, which = np.nonzero(near)
        score = s[who, which]
        for j in range(slots):
            fits = np.flatnonzero((score >= least[part[who], j]) & (score <= most_score[part[who], j]))
            got = fits[_first(who[fits], score[fits], cell.ids[which[fits]], most)]
            slot = np.full(len(got), j)
            for values, x in zip(out, (number[part[who[got]]], slot, cell.ids[which[got]], score[got])):
                values.append(x)
    return _table(["a", "slot", "id", "score"], out)


def _table(names: list[str], columns: list[list[np.ndarray]]) -> pa.Table:
    return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *c]), pa.int64()) for c in columns], names)


def _usable(df: DataFrame, anchor: Column, id: str, label: Column, vector: str, scale: int) -> DataFrame:
    """Rows with whole components; ``m`` numbers them."""
    rows = df.select(
        F.col(id).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("x"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    finite = F.forall("x", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = rows.where("id is not null and label is not null and x is not null").where(finite)
    return rows.select("id", "label", whole.alias("v"), "anchor", F.monotonically_increasing_id().alias("m"))


def mine(
    df: DataFrame, anchor: Column, id: str = "vec_id", label: Column | str = "label", vector: str = "embedding",
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    block: int = BLOCK, rows_at_least: int = ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor (rows where
    ``anchor`` holds) and each of its first ``positives`` other rows of its label, the first ``negatives`` rows of other labels with
    ``low`` * positive score <= ``high`` * negative score <= ``high`` * positive score.  A score is the inner product of
    floor(scale * x); higher scores come first, ties by smaller id.

    Rows with a null id, label or vector, or any null or non-finite component take no part.  Shorter vectors
    count as filled up with zeros; an empty vector scores 0.  Rows equal in id, label and
    vector count once; else rows of one id are rows of their own, but never a positive of an anchor of that id.  Ids and labels
    are whole numbers.  Columns with other names are ignored; an empty table gives an empty result.  Scores that
    might leave 61 bits raise an error before any is computed.

    Work is anchors times rows, in blocks; a row travels once per group of ``block`` components of anchors, and a
    cell keeps ``positives`` or ``negatives`` entries per anchor, whatever its rows."""
    label = F.col(label) if isinstance(label, str) else label
    rows = settle(_usable(df, anchor, id, label, vector, scale), "whole-vectors")
    size = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    n, n_anchors, width, largest = rows.agg(
        F.count("*"), F.count_if("anchor"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(size), F.lit(0.0))
    ).first()
    if largest >= 1 << 31 or width * int(largest) ** 2 >= 1 << 61:
        raise ValueError(f"components up to {largest:.0f} in {width} dimensions leave the range of exact scores")
    primes = primes_for(width * int(largest) ** 2)
    fit = max(1, block // max(1, width))
    n_blocks = -(-n // min(fit, max(rows_at_least, -(-n // BLOCKS)))) or 1
    n_groups = -(-n_anchors // fit) or 1

    numbered = rows.where("anchor").select("id", "label", "v").distinct()
    chosen = settle(numbered.select(F.monotonically_increasing_id().alias("a"), F.col("id").alias("anchor_id"), "label", F.col("v").cast("array<int>").alias("v")), "anchors")
    every = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    dealt = lambda column, count: F.pmod(F.xxhash64(column), F.lit(count)).cast("int")
    right = rows.select("id", "label", F.col("v").cast("array<int>").alias("v"), dealt("m", n_blocks).alias("r"), every(n_groups, "g")).groupBy("r", "g")

    def scored(anchors: DataFrame, fn, schema: str, *options) -> DataFrame:
        left = anchors.select("*", dealt("a", n_groups).alias("g"), every(n_blocks, "r")).groupBy("r", "g")
        return left.cogroup(right).applyInArrow(lambda a, b: fn(a, b, width, primes, *options), schema)

    best = lambda most: F.slice(F.sort_array(F.collect_set(F.struct((-F.col("score")).alias("minus"), "id"))), 1, most)
    found = scored(chosen, _positives, "a long, id long, score long", positives)
    firsts = found.groupBy("a").agg(best(positives).alias("f")).select(
        F.col("a").alias("of"), F.transform("f", lambda x: F.struct(x["id"].alias("id"), (-x["minus"]).alias("score"))).alias("positives")
    )
    pairs = settle(chosen.join(firsts, F.col("a") == F.col("of")).drop("of"), "positives")
    found = scored(pairs, _negatives, "a long, slot long, id long, score long", negatives, low, high)
    firsts = found.groupBy("a", "slot").agg(best(negatives).alias("f")).select(F.col("a").alias("of"), "slot", F.posexplode("f").alias("rank", "n"))
    positive = F.get("positives", F.col("slot").cast("int"))
    return pairs.select("a", "anchor_id", "positives").join(firsts, F.col("a") == F.col("of")).select(
        "anchor_id", positive["id"].alias("positive_id"), (F.col("rank") + 1).alias("rank"), F.col("n.id").alias("negative_id"),
        positive["score"].alias("positive_score"), (-F.col("n.minus")).alias("negative_score"),
    )
