"""Near-duplicate removal against a scan in order."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.operators import dedup
from tests import plain


def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


def corpus(seed, n_base=25, copies=4, length=60):
    """Texts in families of closer and farther copies, exact copies, short ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = ["", "one", "One ", "a b", "a b c", "a b c d"]
    for _ in range(n_base):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(5, length))]
        texts.append(" ".join(base))
        for _ in range(copies):
            texts.append(" ".join(edited(rng, base, rng.choice([0, 1, 1, 2, 4, 9]), vocabulary)))
            if rng.random() < 0.4:
                texts.append(" ".join(base[: -rng.randint(1, 3)]))
    rng.shuffle(texts)
    return texts


def kept(spark, texts, threshold, partitions=4, **kwargs):
    df = spark.createDataFrame(list(enumerate(texts)), "example_id long, text string").repartition(partitions)
    return sorted(r.example_id for r in dedup.kept_keys(df, threshold=threshold, **kwargs).collect())


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95, 1.0])
def test_equals_scan_in_order(spark, threshold):
    texts = corpus(int(threshold * 100))
    assert kept(spark, texts, threshold) == plain.kept(texts, threshold)


@pytest.mark.parametrize("threshold", [0.6, 0.9])
def test_large_groups_give_the_same_result(spark, threshold):
    """With a group limit of 2 nearly every group takes the leader and refine path."""
    texts = corpus(7, n_base=5, copies=7, length=50)
    assert kept(spark, texts, threshold, small_group=2) == plain.kept(texts, threshold)


def test_one_family_holds_most_rows(spark):
    """Near-copies of one text, none equal: a group whose pairs must not be listed."""
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(5000)]
    base = [rng.choice(vocabulary) for _ in range(80)]
    texts = [" ".join(edited(rng, base, 1, vocabulary)) for _ in range(150)] + corpus(4, n_base=5)
    assert kept(spark, texts, 0.9, small_group=10) == plain.kept(texts, 0.9)


@pytest.mark.parametrize(
    ("rows", "words", "own", "threshold"), [(600, 300, 30, 0.95), (400, 200, 32, 0.8)]
)
def test_shared_boilerplate_brings_no_pairs(spark, rows, words, own, threshold):
    """Rows that share most of their text, though not enough to be similar."""
    rng = random.Random(rows)
    shared = [f"s{i}" for i in range(words - own)]
    texts = [" ".join([f"r{r}x{i}" for i in range(own)] + shared) for r in range(rows)]
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "rid long, text string")
    entries = dedup._entries(dedup._hashed(df, 2), threshold)
    prefix = words - 1 - int(threshold * (words - 1)) + 1
    assert entries.count() <= rows * prefix
    assert dedup._pairs_of_small(entries, threshold).count() <= rows
    assert kept(spark, texts, threshold) == list(range(rows))


@pytest.mark.parametrize("small_group", [2, 50])
def test_dissimilar_rows_of_common_words_go_through_tiles(spark, monkeypatch, small_group):
    """Every n-gram is frequent, so groups stay large while few rows are similar."""
    monkeypatch.setattr(dedup, "TILE_ROWS", 7)
    monkeypatch.setattr(dedup, "LEFT_SHARE", 0.0)
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(3, 12))) for _ in range(150)]
    assert kept(spark, texts, 0.6, small_group=small_group) == plain.kept(texts, 0.6)


def test_independent_of_partitioning_and_kept_rows_differ(spark):
    texts = corpus(11, n_base=10)
    assert kept(spark, texts, 0.8, 1) == kept(spark, texts, 0.8, 7)


def test_chain_is_not_a_component(spark):
    """b is near a and c, a and c are apart: b goes, c stays."""
    a = " ".join(f"x{i}" for i in range(40))
    b = " ".join([f"x{i}" for i in range(38)] + ["y1", "y2"])
    c = " ".join(["z1", "z2"] + [f"x{i}" for i in range(2, 38)] + ["y1", "y2"])
    assert plain.kept([a, b, c], 0.85) == [0, 2]
    assert kept(spark, [a, b, c], 0.85) == [0, 2]


def test_examples_compare_both_fields_and_keep_rows_whole(spark):
    df = spark.createDataFrame(
        [(1, "hello there my friend", "good day", "x"), (2, "hello there", "my friend good day", "y"), (3, None, "other", "z")],
        "example_id long, user string, assistant string, category string",
    )
    rows = {r.example_id: r.category for r in dedup.deduplicate_examples(df).collect()}
    assert rows == {1: "x", 3: "z"}


def test_threshold_is_checked(spark):
    with pytest.raises(ValueError):
        dedup.kept_keys(spark.createDataFrame([(1, "a")], "example_id long, text string"), threshold=0)


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_sketches_let_every_similar_pair_through(spark, threshold):
    """Sizes on both sides of a doubling, so that sketches of two lengths meet; far pairs go."""
    rng = random.Random(9)
    pairs, rows, similar, far = [], [], set(), set()
    for p in range(300):
        base = [f"p{p}x{i}" for i in range(rng.choice([1, 3, 30, 31, 33, 60, 65, 130, 500]))]
        other = base[: len(base) - rng.randint(0, len(base) // 4)] + [f"q{p}x{i}" for i in range(rng.randint(0, len(base) // 2))]
        rows += [(2 * p, " ".join(base)), (2 * p + 1, " ".join(other))]
        pairs.append((2 * p, 2 * p + 1))
        share = len(set(base) & set(other)) / len(set(base) | set(other))
        (similar if share >= threshold else far).add(pairs[-1])
    pairs += [(2 * p, 2 * p + 3) for p in range(299)]
    texts = spark.createDataFrame(rows, "rid long, text string")
    sketches = dedup._prefixes(dedup._hashed(texts, 1), threshold, dedup._frequent(dedup._hashed(texts, 1)))
    sketches = sketches.select("rid", "size", "sketch")
    allowed = dedup._sketches_allow(spark.createDataFrame(pairs, "lo long, hi long"), sketches, threshold)
    allowed = {tuple(r) for r in allowed.collect()}
    assert similar <= allowed and len(similar) > 50
    sizes = {key: len(set(text.split())) for key, text in rows}
    long = [(a, b) for a, b in pairs[300:] if 130 <= min(sizes[a], sizes[b]) and max(sizes[a], sizes[b]) <= 1.25 * min(sizes[a], sizes[b])]
    assert long and not allowed & set(long)


def test_a_worker_orders_few_ngrams_at_once(spark, monkeypatch):
    import pyarrow as pa

    sizes = [5, 4, 1, 30, 2, 8, 3]
    lists = [list(range(n)) for n in sizes]
    batch = pa.record_batch([pa.array(range(7)), pa.array(sizes, pa.int32()), pa.array(lists, pa.list_(pa.int64()))], ["rid", "size", "hashes"])
    parts = list(dedup._pieces(iter([batch]), 10))
    assert [p.column("size").to_pylist() for p in parts] == [[5, 4, 1], [30], [2, 8], [3]]
    assert [x for p in parts for x in p.column("hashes").to_pylist()] == lists
    rows = [(i, " ".join(f"w{(i // 3 * 50 + k)}" for k in range(40)) + (" x" if i % 3 else "")) for i in range(30)]
    df = spark.createDataFrame(rows, "k long, t string").coalesce(1)
    monkeypatch.setattr(dedup, "BATCH_GRAMS", 50)
    assert sorted(r.k for r in dedup.kept_keys(df, "k", "t", 0.8).collect()) == list(range(0, 30, 3))


def test_ngrams_of_many_rows_bring_few_pairs_in_a_large_table(spark, monkeypatch):
    """Words in 160 of 1,600 rows go last in the order, as the rows counted for it grow with the table."""
    monkeypatch.setattr(dedup, "SAMPLE_ROWS", 4)
    real, listed = dedup._check_pairs, []

    def spy(pairs, *rest):
        listed.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(dedup, "_check_pairs", spy)
    rng = random.Random(2)
    pool = [f"p{i}" for i in range(300)]
    texts = [" ".join([f"r{r}x{i}" for i in range(30)] + rng.sample(pool, 30)) for r in range(1_600)]
    assert kept(spark, texts, 0.8, n=1) == list(range(1_600))
    assert sum(listed) < 1_600


def test_rows_are_written_once_before_entries(spark, monkeypatch):
    names, real = [], dedup.settle
    monkeypatch.setattr(dedup, "settle", lambda df, name="table": names.append(name) or real(df, name))
    texts = corpus(12, n_base=4)
    assert kept(spark, texts, 0.8) == plain.kept(texts, 0.8)
    assert not {"sample", "prefixes"} & set(names)


def test_order_is_total_where_numbers_tie():
    rng = np.random.default_rng(4)
    grams = rng.permutation(np.unique(rng.integers(0, 1 << 40, 500)))
    row, times = np.arange(len(grams)) * 3 // len(grams), rng.integers(0, 3, len(grams)).astype("uint8")
    short = grams >> 27 & ((1 << 37) - 1)
    assert dedup._order(grams, row, times).tolist() == np.lexsort((grams, short, times, row)).tolist()


def test_sketches_are_as_long_as_the_threshold_asks():
    size = np.array([400])
    grams = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 400)
    words = [len(dedup._sketches(grams, np.zeros(400, "int64"), size, t)[0]) for t in (0.5, 0.8, 0.95)]
    assert words == [16, 8, 2]


ODD_TEXTS = [
    "", "  ", "one", "One  ", "a b", "a  b", "A\x1fB c", "a b c d e f", "a b a b a b a b", "ä Ü x　y\x85z a b",
    "b a", "ab", "a​b c d e", "\x00 a", "e f a b c d", "\U0001f600 \U0001f600 x \U0001f600 \U0001f600",
]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_ngrams_hashed_in_one_pass_are_the_shingles(spark, n):
    """Equal hashes for equal n-grams only, digests as in Spark, whatever the size of a piece."""
    import pyarrow as pa

    df = spark.createDataFrame(list(enumerate([*ODD_TEXTS, *corpus(3, n_base=4)])), "rid long, text string")
    sets = df.select("rid", dedup.X.shingles(F.col("text"), n).alias("s"), dedup._sequence(n).alias("d"), dedup.X.strip(F.lower("text")).alias("w"))
    sets = sets.orderBy("rid").collect()
    for kind in (pa.string(), pa.large_string()):
        batch = pa.record_batch([pa.array([r.rid for r in sets]), pa.array([r.w for r in sets], kind)], ["rid", "whole"])
        for most in (1, 7, 1 << 18):
            rows = [r for b in dedup._grams(iter([batch]), n, most) for r in b.to_pylist()]
            assert [(r["rid"], r["digest"]) for r in rows] == [(r.rid, bytes(r.d)) for r in sets]
            known = {}
            for r, want in zip(rows, sets):
                assert r["size"] == len(r["hashes"])
                once = list(dict.fromkeys(r["hashes"]))
                assert len(once) == len(want.s)
                for gram, h in zip(want.s, once):
                    assert known.setdefault(gram, h) == h
            assert len(set(known.values())) == len(known)
    hashed = {r.rid: (r.size, len(set(r.hashes))) for r in dedup._hashed(df, n).collect()}
    assert hashed == {r.rid: (len(r.s), len(r.s)) for r in sets}


def test_arrow_splits_at_the_librarys_white_space():
    import pyarrow as pa
    import pyarrow.compute as pc

    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    parts = pc.list_value_length(pc.utf8_split_whitespace(pa.array([f"a{c}b" for c in every]))).to_pylist()
    assert [c for c, k in zip(every, parts) if k > 1] == sorted(dedup.fixed.SPACE_CHARS)


def test_no_text_is_split_or_hashed_word_by_word_for_its_prefix(spark, monkeypatch):
    """Spark's functions of lists do so word by word: that step took 123 of 273 task seconds on check_l, and takes 55 of 194."""
    plans, real = {}, dedup.settle

    def spy(df, name="table"):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(dedup, "settle", spy)
    texts = corpus(13, n_base=4)
    assert kept(spark, texts, 0.8) == plain.kept(texts, 0.8)
    for step in ("lowest", "hashes"):
        assert "lambdafunction" not in plans[step] and "split(" not in plans[step]
