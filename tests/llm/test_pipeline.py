"""Registered queries on the small tables; the pipeline against a plain version of its stages."""

import collections
import os
import random
import sys

import duckdb
import public_tokenizers
import pytest
import tiktoken

from colloquy.llm import bpe, pii_bootstrap, quality_rules
from colloquy.llm.oracles import ORACLES
from colloquy.llm.queries import QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    with duckdb.connect() as db:
        for t in ("documents", "conversations"):
            db.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
        expected = db.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SMALL).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    rows = lambda d: sorted(map(str, d[columns].astype(object).itertuples(index=False, name=None)))
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op8_ann", "op13_hard_negatives"}))
def test_query_covers_its_table(spark, name):
    table = "pages" if name == "op2_url_boost" else "documents"
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in quality_rules.judged(docs, ["doc_id"]).where("kept").collect()}
    sets, stay = {}, set()
    for i in sorted(kept):
        words = rows[i].text.lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        if not any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in stay):
            stay.add(i)
    stages = dict(corpus_pipeline.STAGES)
    filtered = stages["quality_rules"](spark, docs, SMALL)
    assert sorted(r.doc_id for r in filtered.collect()) == sorted(kept)
    assert sorted(r.doc_id for r in stages["exact_near_dedup"](spark, filtered, SMALL).collect()) == sorted(stay)
    assert len(stay) < len(kept)
    tokenizer = bpe.tokenizer_at(public_tokenizers.path(corpus_pipeline.VOCABULARY), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={})
    got = collections.Counter()
    words = 0
    for r in corpus_pipeline.run(spark, SMALL).collect():
        got[r.doc_id] += 1
        words += len(rows[r.doc_id].text.split())
        text = rows[r.doc_id].text
        found = [(s.kind, s.start, s.end) for s in corpus_spans(spark, docs)[r.doc_id]]
        assert r.n_tokens == len(r.ids) and list(r.ids) == library.encode_ordinary(pii_bootstrap.mask(text, found))
    assert set(got) <= stay and max(got.values()) <= 2
    whole = sum(len(rows[i].text.split()) for i in stay)
    assert abs(words - 1.5 * whole) < 0.1 * whole


_SPANS = {}


def corpus_spans(spark, docs):
    if not _SPANS:
        for r in pii_bootstrap.marked(docs, ["doc_id"]).collect():
            _SPANS[r.doc_id] = [*r.base, *r.found]
    return _SPANS


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, SMALL)
        assert out.columns == empty.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SMALL).count() == 0


def test_dedup_stage_takes_every_near_copy(spark, documents):
    """Against a scan in key order with exact sets of five words; copies of each similarity, keys repeated and null."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for g in range(40):
        words = [word() for _ in range(80)]
        rows.append((3 * g, " ".join(words), "s"))
        for edits in (1, 2, 3, 6):
            copy = list(words)
            for _ in range(edits):
                copy[rng.randrange(80)] = word()
            rows.append((rng.choice([None, 3 * g + 1, 3 * g]), " ".join(copy), "s"))
    grams = lambda t: {tuple(w[i : i + 5]) for w in [t.split()] for i in range(len(w) - 4)}
    kept = []
    for i, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        a = grams(text)
        if not any(len(a & b) >= 0.8 * len(a | b) for _, b, _ in kept):
            kept.append((text, a, i))
    stage = dict(corpus_pipeline.STAGES)["exact_near_dedup"]
    got = stage(spark, documents(rows).coalesce(1), SMALL).collect()
    assert sorted((r.text, str(r.doc_id)) for r in got) == sorted((t, str(i)) for t, _, i in kept)
    assert 40 < len(got) < len(rows)


def test_stages_take_clashing_columns_and_nulls(spark, documents):
    """Extra columns named like the operators' own; null keys, texts and sources; repeated rows."""
    clean = "the river was long and the road to the town of our friends went on for many days and it was hot. "
    rows = [(i, clean + f"In the year {i} they had {i * 3} ships with sails and {i + 5} masts of old wood for the king {i}.", "s") for i in range(6)]
    rows += [(None, None, None), (7, "", None), (None, rows[0][1], None), rows[1], (8, f"mail me at a.b{8}@example.com {clean}", "t")]
    clashing = ("spans", "row", "id", "kept", "target", "h", "fp", "position", "rid", "size", "ids", "n_tokens")
    docs = documents(rows).selectExpr("*", *[f"concat('x', doc_id) as {c}" for c in clashing])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        assert {r.spans for r in out.collect()} <= {None, *(f"x{i}" for i in range(9))}, name
    masked = pii_bootstrap.masked(docs).collect()
    assert len(masked) == len(rows) and sum("[EMAIL]" in (r.text or "") for r in masked) == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == len(rows)


def test_dedup_stage_takes_copies_by_simhash(spark, documents, monkeypatch):
    """Copies and near copies come from fingerprints and an exact check; nothing else lists their pairs."""
    from colloquy.llm import simhash
    from colloquy.operators import dedup

    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words), "s"), (2, "  ".join(words), "s"), (3, " ".join([*words[:-1], "other"]), "s"), (4, "something else", "s")]
    bits = simhash.fingerprint(rows[0][1]) ^ simhash.fingerprint(rows[2][1])
    assert 0 <= (bits % (1 << 64)).bit_count() <= simhash.RADIUS
    first, pairs = simhash.candidates(documents(rows).selectExpr("doc_id as rid", "text", "md5(regexp_replace(text, ' +', ' ')) as digest"))
    assert sorted(r.rid for r in first.collect()) == [1, 3, 4]
    assert {(r.lo, r.hi) for r in pairs.collect()} == {(1, 3)}
    monkeypatch.setattr(dedup, "_pairs_of_small", lambda entries, threshold: entries.selectExpr("rid as lo", "rid as hi").limit(0))
    stage = dict(corpus_pipeline.STAGES)["exact_near_dedup"]
    assert sorted(r.doc_id for r in stage(spark, documents(rows), SMALL).collect()) == [1, 4]
