"""Repeated byte strings, periodic runs and hard negatives, against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import negatives, periods, queries, repeats

SMALL = "/root/testdata/sf0.001"


def slow_cut(texts, length):
    """(bytes, removed, stretches, kept) of each text, by counting every string."""
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        stretches = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), stretches, bytes(b for b, g in zip(d, gone) if not g)))
    return out


@pytest.mark.parametrize("length, crowd, letters", [(8, 2048, "ab"), (12, 3, "abc"), (20, 2, "abcdé"), (200, 4, "abcdefgh ")])
def test_repeats_equal_brute_force(spark, length, crowd, letters):
    rng = random.Random(length)
    noise = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [noise(int(length * rng.uniform(0.8, 2.5))) for _ in range(6)]
    texts = [None, "", "a", passages[0], passages[0], "a" * (3 * length)]
    for _ in range(50):
        text = noise(rng.randrange(3 * length))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            start = rng.randrange(len(p) // 2)
            text += p[start : start + rng.randrange(len(p))] + noise(rng.randrange(length))
        texts.append(text)
    texts += texts[10:13]
    df = spark.createDataFrame(list(enumerate(texts)), "spans long, text string").withColumn("data", F.lit(1)).repartition(3)
    rows = repeats.without_repeats(df, ["spans", "data"], length=length, crowd=crowd).collect()
    found = {r.spans: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}
    assert len(rows) == len(texts)
    assert [found[i] for i in range(len(texts))] == slow_cut(texts, length)


def test_repeats_of_long_texts_cross_chunks(spark, monkeypatch):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(700))
    long = "".join(rng.choice("ijklmnop ") for _ in range(400_000))
    texts = [long[:261_800] + passage + long[261_800:], passage[100:], "tail " + long[300_000:300_250]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in repeats.without_repeats(df, ["doc_id"]).collect()}
    assert rows[0].n_removed == 600 + 250 and rows[0].n_spans == 2
    assert bytes(rows[0].kept) == (long[:261_800] + passage[:100] + long[261_800:300_000] + long[300_250:]).encode()
    assert bytes(rows[1].kept) == b"" and bytes(rows[2].kept) == b"tail "


def test_repeat_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {
        (d.doc_id, n, gone, runs, hashlib.sha256(kept).hexdigest())
        for d, (n, gone, runs, kept) in zip(docs, slow_cut([d.text for d in docs], 200))
    }
    rows = queries.op11_maximal_repeats(spark, SMALL).collect()
    assert len(rows) == len(docs) and {tuple(r) for r in rows} == want


def test_spans_of_one_group_hold_equal_bytes(spark):
    texts = [f"{i} one passage that many of these texts share, word for word {i * 7919}" for i in range(9)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    whole = {tuple(r): t for t in texts for r in spark.createDataFrame([(t,)], "t string").select(F.xxhash64("t"), F.xxhash64(F.lit("text"), "t")).collect()}
    groups = collections.defaultdict(set)
    for r in repeats.repeated(df, length=24).collect():
        groups[r.group].add(whole[r.k1, r.k2].encode()[r.start : r.end])
    assert groups and all(len(g) == 1 for g in groups.values())


def slow_runs(words, least, times):
    """Maximal runs by comparing all words q apart."""
    n, out = len(words), set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i + q - start
            run = words[start : start + size]
            smaller = lambda: any(run[d:] == run[:-d] for d in range(1, q))
            if i > start and size >= max(least, times * q) and not smaller():
                out.add((start, size, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng, n, letters):
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        a, p = rng.randrange(n), rng.randrange(1, 9)
        for i in range(a + p, min(n, a + p * rng.randrange(3, 9))):
            words[i] = words[i - p]
    return [f"w{w}" for w in words]


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (4, 3)])
def test_runs_equal_brute_force(spark, least, times):
    rng = random.Random(times)
    texts = [repetitive(rng, rng.randrange(1, 70), rng.choice([1, 2, 3, 6, 20])) for _ in range(400)]
    rows = [(i, " \t\n".join(t)) for i, t in enumerate(texts)] + [(None, None), (-1, ""), (-1, " \x0b ")]
    df = spark.createDataFrame(rows, "runs long, text string").repartition(3)
    found = periods.runs(df.withColumnRenamed("runs", "id").withColumn("collapsed", F.lit(0)), ["id"], least=least, times=times).collect()
    assert len(found) == len(rows)
    for r in found:
        words = texts[r.id] if r.id is not None and r.id >= 0 else []
        want = slow_runs(words, least, times)
        dropped = {i for s, size, q in want for i in range(s + q, s + size)}
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(words)
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_run_stretches_leave_ordinary_text_out():
    words = np.arange(10_000) % 5_000
    assert periods._stretches(words, np.zeros(len(words), np.int64), 6, 4) == []
    words[7_000:7_012] = 1
    (only,) = periods._stretches(words, np.zeros(len(words), np.int64), 6, 4)
    assert only[0] <= 7_000 and only[1] == 7_012 and only[1] - only[0] < 40


def test_run_query_equals_brute_force(spark):
    want = []
    for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        words = [w.decode() for w in (d.text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        # Long periods only where they can fill the text; numbers compare faster than words.
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        runs = slow_runs([number[w] for w in words], 6, 4) if n < 800 else None
        if runs is None:
            continue
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want.append((
            d.doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        ))
    found = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, SMALL).collect()}
    assert len(want) > 100 and sum(w[1] for w in want) > 3
    assert all(found[w[0]] == w for w in want)


def slow_negatives(rows, shift=False):
    kept = set()
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.add((i, (label + 1) % 10 if shift and i % 7 == 0 else label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for i, label, v in kept:
        if i % 100:
            continue
        scores = [(j, m, dot(v, w)) for j, m, w in kept]
        for minus, j in sorted({(-s, j) for j, m, s in scores if j != i and m == label})[:5]:
            fits = {(-s, k) for k, m, s in scores if m != label and 80 * -minus <= 100 * s <= 100 * -minus}
            out |= {(i, j, r + 1, k, -minus, -s) for r, (s, k) in enumerate(sorted(fits)[:5])}
    return out


@pytest.mark.parametrize("width, scale", [(8, 1.0), (3, 1000.0), (70, 0.2)])
def test_negatives_equal_brute_force(spark, width, scale):
    rng = random.Random(width)
    value = lambda: rng.choice([0, 0.25, 0.5, 1, -1]) * scale * (rng.random() if rng.random() < 0.5 else 1.0)
    rows = [(rng.randrange(500), rng.randrange(3), [value() for _ in range(width)]) for _ in range(700)]
    rows += [(None, 1, [1.0]), (0, None, [1.0]), (100, 1, None), (200, 1, [1.0, None]), (200, 2, [float("nan")])]
    rows += [(300, 1, [float("inf")]), (400, 1, []), (400, 2, [1.0, 2.0])] + rows[:30]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({"a": F.lit(1), "v": F.lit(2)})
    found = [tuple(r) for r in negatives.mine(df.repartition(3), F.col("vec_id") % 100 == 0, block=width * 64, rows_at_least=50).collect()]
    want = slow_negatives(rows)
    assert len(found) == len(want) > 100 and set(found) == want


def test_negative_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    found = [tuple(r) for r in queries.op13_hard_negatives(spark, SMALL).collect()]
    want = slow_negatives([tuple(r) for r in rows], shift=True)
    assert want and len(found) == len(want) and set(found) == want


def test_residue_products_are_exact_and_bounded(spark):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-(1 << 20), 1 << 20, (n, 3_000)) for n in (20, 30))
    assert (negatives.products(a, b) == a @ b.T).all()
    assert len(negatives.primes_for(64 * 256 * 256)) == 3
    huge = spark.createDataFrame([(0, 1, [1e30])], "vec_id long, label int, embedding array<float>")
    with pytest.raises(ValueError, match="range of exact scores"):
        negatives.mine(huge, F.lit(True))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert repeats.without_repeats(docs, ["doc_id"]).count() == 0
    assert periods.digests(docs, ["doc_id"]).count() == 0
    assert negatives.mine(vectors, F.col("vec_id") % 100 == 0).count() == 0
