"""Files, whole runs, streams, and every registered query against its SQL."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from colloquy import schemas
from colloquy.plans import cleaning, evaluation, preparation
from colloquy.sources import files
from colloquy.streaming import rows

from colloquy.registry.oracles import ORACLES
from colloquy.registry.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"

EXAMPLES = [
    (1, 'said "hi",\nthen left', "türkçe ö", "c1", "s"),
    (2, "", None, None, "s"),
    (3, "back\\slash", "tab\there", "c2", "s"),
]


def test_files_round_trip(spark, folder):
    df = spark.createDataFrame(EXAMPLES, schemas.EXAMPLES)
    files.write_csv(df, f"{folder}/csv")
    files.write_json(df, f"{folder}/json")
    files.write_parquet(df, f"{folder}/parquet")
    assert sorted(map(tuple, files.read_json(spark, f"{folder}/json", schemas.EXAMPLES, True).collect())) == sorted(EXAMPLES)
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/parquet").collect())) == sorted(EXAMPLES)
    assert [tuple(r)[:2] for r in files.read_csv(spark, f"{folder}/csv", schemas.EXAMPLES).orderBy("example_id").collect()][0] == (1, EXAMPLES[0][1])
    text = "".join(open(f"{folder}/json/{f}", encoding="utf-8").read() for f in os.listdir(f"{folder}/json") if f.startswith("part"))
    assert "türkçe" in text


def test_json_documents_and_directory(spark, folder):
    for name, body in (("b.json", '{"example_id": 3, "user": "z"}'), ("a.json", '[{"example_id": 1}, {"example_id": 2}]'), ("c.txt", "{}")):
        with open(f"{folder}/{name}", "w") as f:
            f.write(body)
    read = files.read_directory(spark, folder, schemas.EXAMPLES)
    got = read.orderBy("source_file", "source_block", "row_order").collect()
    assert [r.example_id for r in got] == [1, 2, 3]
    assert files.read_json(spark, f"{folder}/b.json", schemas.EXAMPLES).first().user == "z"
    with open(f"{folder}/l.jsonl", "w") as f:
        f.write('{"example_id": 1}\n\n{"example_id": 2}\n')
    assert files.read_directory(spark, folder, schemas.EXAMPLES, "*.jsonl", True).count() == 2
    with pytest.raises(Exception):
        files.read_csv(spark, f"{folder}/missing.csv", schemas.EXAMPLES).collect()


def test_report_is_one_document_in_order(spark, folder):
    df = spark.createDataFrame([("é", 1.5)], "name string, value double")
    files.write_report(df, f"{folder}/r")
    assert files.read_report(spark, f"{folder}/r", df.schema).collect() == df.collect()
    long = spark.range(12_000).selectExpr("id", "id % 7 AS x").repartition(5).orderBy("id")
    files.write_report(long, f"{folder}/long")
    assert files.read_report(spark, f"{folder}/long", long.schema).collect() == long.collect()
    files.write_report(df.limit(0), f"{folder}/none")
    assert files.read_report(spark, f"{folder}/none", df.schema).count() == 0


def test_preparation_run(spark, folder):
    examples = preparation.generate_examples(spark, 200)
    done = preparation.prepare(examples, folder)
    funnel = {r.stage: r.n for r in done.funnel.collect()}
    kept = funnel["after_quality_filtering"]
    assert funnel["original_count"] == funnel["after_pii_masking"] == examples.count()
    sizes = [files.read_split(spark, f"{folder}/splits", s).count() for s in ("train", "validation", "test")]
    assert sizes == [int(kept * 0.8), int(kept * 0.1), kept - int(kept * 0.8) - int(kept * 0.1)]
    assert files.read_preferences(spark, f"{folder}/train_preferences").count() == sizes[0]
    plan = files.read_split(spark, f"{folder}/splits", "test")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    stored = files.read_training_text(spark, f"{folder}/splits", "unused")
    assert stored.count() == kept
    assert cleaning.retention_rate(done.funnel).first()[0] == pytest.approx(100.0 * kept / funnel["original_count"])


def test_cleaning_switches(spark):
    good = "You can renew it in the portal at any time."
    df = spark.createDataFrame(
        [(1, "mail a@b.co please today", good, "c", "s"), (2, "mail x@y.co please today", good, "c", "s"), (3, "a", "b", "c", "s")],
        schemas.EXAMPLES,
    )
    ids = lambda c: sorted(r.example_id for r in c.examples.collect())
    everything = cleaning.clean(df)
    assert ids(everything) == [1]
    assert {r.stage: r.n for r in everything.funnel.collect()} == {
        "original_count": 3, "after_pii_masking": 3, "after_deduplication": 2, "after_quality_filtering": 1,
    }
    assert [tuple(r) for r in everything.pii_found.collect()] == [("user", "email", 2)]
    off = cleaning.clean(df, mask_pii=False, remove_duplicates=False, filter_by_quality=False)
    assert ids(off) == [1, 2, 3] and off.pii_found.count() == 0
    empty = cleaning.clean(df.where("false"), remove_duplicates=False)
    assert cleaning.retention_rate(empty.funnel).first()[0] is None


def test_evaluation_run(spark, folder):
    df = spark.createDataFrame(
        [(i, f"q{i}", f"the answer number {i} is here", "policy_inquiry", "s") for i in range(7)], schemas.EXAMPLES
    )
    done = evaluation.evaluate_offline(df, folder)
    overall = {r.level: r for r in done.self_metrics.collect()}["overall"]
    assert overall.rouge_l == 1.0 and overall.num_examples == 7
    assert [r.example_id for r in done.comparisons.collect()] == [0, 1, 2, 3, 4]
    answers = df.select("example_id", F.col("assistant").alias("prediction"))
    both = evaluation.evaluate_models(df, answers.where("example_id < 3"), answers, f"{folder}/models")
    assert {r.level: r.bleu for r in both.self_metrics.collect()}["overall"] == 1.0


def test_stream_equals_batch(spark, folder):
    batch = spark.read.parquet(f"{DATA}/documents.parquet").select(
        F.col("doc_id").alias("example_id"), F.substring_index("text", "\n", 1).alias("user"),
        F.col("text").alias("assistant"), F.lit("c").alias("category"), F.lit("s").alias("source"),
    )
    batch.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(schemas.EXAMPLES).parquet(f"{folder}/in")
    rows.run_available(rows.clean_rows(stream), f"{folder}/out", f"{folder}/state")
    expected = rows.clean_rows(batch)
    got = spark.read.parquet(f"{folder}/out")
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(map(str, r)) for r in df.select(*columns).collect())
    result = duck.execute(entry.oracle_sql()[name])
    theirs = [d[0] for d in result.description]
    order = [theirs.index(c) for c in columns]
    assert sorted(theirs) == columns
    assert ours == sorted(tuple(str(r[i]) for i in order) for r in result.fetchall())


def test_answers_are_made_in_many_tasks(spark):
    """The customers' file is one task's; texts and scores are not left to it."""
    from colloquy.registry import inputs

    assert inputs.customers(spark, DATA).rdd.getNumPartitions() == 1
    assert inputs.reference_answers(spark, DATA).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
