"""Quality scores from a generalised additive model with pairwise interactions.

Cyclic boosting: each round fits a shallow tree on one feature after another, at a small rate, and adds
its leaf values to the feature's table of bins; afterwards pairs of features get two-way tables the
same way, on what is left.  A score is the sum of one table entry per feature and pair.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.batches import map_rows
from colloquy.operators.lineage import settle

#: Labelled rows used for training at most: those of the smallest key hashes.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAVES = 60, 20, 0.15, 3
#: Added to each sum of second derivatives; keeps sparse bins near zero.
SHRINK = 4.0

FEATURES = [
    "log_words", "log_lines", "mean_word", "longest_word", "symbol_ratio", "digit_ratio", "upper_ratio",
    "stop_ratio", "end_mark_ratio", "distinct_ratio", "same_as_last_ratio", "same_line_ratio", "top_word_ratio",
    "words_per_line",
]
#: Short function words of English, French, German and Spanish.
STOP = frozenset(
    (
        "the of and to in is was for on that with as by at from this it be are or an a "
        "le la les de des du et en un une que qui dans pour sur il est au "
        "der die das und ist nicht mit den von zu ein eine auf im dem sich "
        "el los las y del se por con su para lo al"
    ).encode().split()
)
SYMBOLS, DIGITS = b"#*$%&|<>=~^_{}[]\\", b"0123456789"
UPPER, ENDS = bytes(range(65, 91)), b".!?"


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text; all zero without words."""
    data = (text or "").encode("utf-8")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(data)
    lower = data.lower().split()
    counts: dict[bytes, int] = {}
    for w in lower:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = lambda chars: (size - len(data.translate(None, chars))) / size
    chars = sum(map(len, words))
    return [
        float(np.log1p(n)),
        float(np.log1p(len(lines))),
        chars / n,
        float(min(100, max(map(len, words)))),
        share(SYMBOLS) * size / n,
        share(DIGITS),
        share(UPPER),
        sum(counts[w] for w in STOP & counts.keys()) / n,
        share(ENDS) * size / n,
        len(counts) / n,
        sum(map(bytes.__eq__, lower, lower[1:])) / n,
        1 - len(set(lines)) / len(lines),
        max(counts.values()) / n,
        min(1000.0, n / len(lines)),
    ]


@dataclass
class Gam:
    """``edges`` and ``tables`` by feature, ``pairs`` with two-way tables over coarser edges."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of ``x``: bin lookups, added up."""
        total = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, f], "left")]
        bins = [np.searchsorted(e, x[:, f], "left") for f, e in enumerate(self.coarse)]
        for a, b, table in self.pairs:
            total += table[bins[a], bins[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf values by bin of a tree over ordered bins, split greedily by gain."""
    value = lambda a, b: g[a:b].sum() / (h[a:b].sum() + SHRINK)
    worth = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + SHRINK)
    spans = [(0, len(g))]
    while len(spans) < leaves:
        gains = [
            (worth(a, c) + worth(c, b) - worth(a, b), i, c)
            for i, (a, b) in enumerate(spans)
            for c in range(a + 1, b)
        ]
        if not gains or (best := max(gains, key=lambda x: x[0]))[0] <= 1e-9:
            break
        a, b = spans.pop(best[1])
        spans[best[1] : best[1]] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = value(a, b)
    return out


def fit_gam(x: np.ndarray, y: np.ndarray) -> Gam:
    """Fit on a bounded sample.  Without rows, or with rows of one label, all scores are the label's
    smoothed share."""
    model = Gam(base=float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    if not len(y) or y.min() == y.max():
        return model
    model.edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, f], "left") for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)

    def gradients(cell: np.ndarray, cells: int):
        p = 1 / (1 + np.exp(-total))
        return (
            np.bincount(cell, y - p, cells),
            np.bincount(cell, p * (1 - p), cells),
        )

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            step = RATE * _tree(*gradients(bins[f], len(table)), LEAVES)
            table += step
            total += step[bins[f]]
    model.coarse = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    rough = [np.searchsorted(e, x[:, f], "left") for f, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]
    found = []
    for a in range(len(sizes)):
        for b in range(a + 1, len(sizes)):
            g, h = gradients(rough[a] * sizes[b] + rough[b], sizes[a] * sizes[b])
            found.append((float((g * g / (h + SHRINK)).sum()), a, b))
    for _, a, b in sorted(found, key=lambda t: (-t[0], t[1:]))[:PAIRS]:
        model.pairs.append((a, b, np.zeros((sizes[a], sizes[b]))))
    for _ in range(PAIR_ROUNDS):
        for a, b, table in model.pairs:
            cell = rough[a] * sizes[b] + rough[b]
            g, h = (v.reshape(table.shape) for v in gradients(cell, table.size))
            rows = np.stack([_tree(x, w, 2) for x, w in zip(g, h)])
            table += RATE * rows
            total += RATE * rows[rough[a], rough[b]]
    return model


FEATURE_TYPE = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))])


def described(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the features ``x`` of each whole text (null: empty)."""
    return map_rows(df, text, keep, FEATURE_TYPE, lambda: lambda t: [(features(t),)])


def train(rows: DataFrame, labels: DataFrame, usable: Column, key="doc_id", label="quality", sample: int = SAMPLE) -> Gam:
    """A model from described rows and their labels (0 or 1; others and null do not count).

    Of a key with several labels the rounded mean counts, of more than ``sample`` rows those with the
    smallest hashes.  Only that sample reaches the driver."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.round(F.avg(label)).cast("int").alias("y"))
    got = (
        rows.where(usable).join(known, key)
        .select(F.xxhash64(F.lit(4), F.col(key)).alias("h"), "x", "y")
        .orderBy("h", "y", "x").limit(sample).toArrow()
    )
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return fit_gam(x, np.array(got["y"].to_pylist(), float))


def scored(rows: DataFrame, model: Gam) -> DataFrame:
    """Described rows with ``score`` in place of ``x``; no shuffle."""
    keep = [c for c in rows.columns if c != "x"]
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(len(keep)).flatten().to_numpy(zero_copy_only=False)
            score = model.score(values.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(score)], schema.names)

    return rows.select(*keep, "x").mapInArrow(run, schema)


def quality_scores(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    usable: Column | None = None, sample: int = SAMPLE,
) -> DataFrame:
    """``key, score`` for every row; ``usable`` says on ``key`` which labels may be learned from.

    Texts are read once, into a stored table of features.  Null and empty texts are scored like
    others; repeated rows get equal scores; other columns are dropped; an empty table gives none."""
    rows = settle(described(df.select(key, text), [key], text), "features")
    return scored(rows, train(rows, labels, F.lit(True) if usable is None else usable, key, label, sample))
