"""The registered queries of this folder."""

import public_tokenizers
from pyspark.sql import functions as F

from colloquy.llm import (
    ann, bpe, curriculum, gam_quality, licences, negatives, periods, pii_bootstrap, preference, quality_rules, repeats, simhash,
    url_boost,
)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
URL_RULES = [
    url_boost.UrlRule("allow", "com/"),
    url_boost.UrlRule("block", "example.com/en/"),
    url_boost.UrlRule("allow", "www.example.com/en/"),
    url_boost.UrlRule("block", "net/es/"),
    url_boost.UrlRule("block", "net/fr/"),
]
QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_pii_bootstrap(spark, folder):
    rows = pii_bootstrap.marked(table(spark, folder, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in pii_bootstrap.KINDS],
        F.sha2(pii_bootstrap.span_text(F.col("base")), 256).alias("base_sha256"),
        pii_bootstrap.span_text(F.concat("base", "found")).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )


@query
def op2_url_boost(spark, folder):
    return url_boost.judged(table(spark, folder, "pages"), ["page_id"], URL_RULES)


@query
def op3_simhash(spark, folder):
    rows = simhash.grouped(table(spark, folder, "documents"))
    return rows.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op4_gam_quality(spark, folder):
    held_out = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), F.lit(False))
    rows = gam_quality.quality_scores(
        table(spark, folder, "documents"), table(spark, folder, "labels"), usable=~held_out
    )
    return rows.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op5_quality_rules(spark, folder):
    return quality_rules.judged(table(spark, folder, "documents"), ["doc_id"], lang=F.col("lang")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op6_curriculum(spark, folder):
    return curriculum.mixed(table(spark, folder, "documents"), ["doc_id"])


@query
def op7_bpe(spark, folder):
    path = public_tokenizers.path(VOCABULARY)
    return bpe.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN, ["doc_id"])


@query
def op8_ann(spark, folder):
    return ann.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


@query
def op9_preference(spark, folder):
    turns = preference.turns(table(spark, folder, "conversations"))
    rows = preference.formatted(preference.with_other_answers(turns))
    return rows.select(
        F.col("pair").alias("conv_id"), "part", "chunk", "n_turns", "text", preference.mask_text(F.col("mask")).alias("mask")
    )


@query
def op10_licences(spark, folder):
    rows = licences.scanned(table(spark, folder, "documents"), ["doc_id"])
    places = F.transform("matches", lambda m: F.concat_ws(":", m["licence"], m["start"].cast("string"), m["end"].cast("string")))
    return rows.select(
        "doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join(places, ",").alias("matches"), F.array_join("licences", ",").alias("licences"),
    )


@query
def op11_maximal_repeats(spark, folder):
    rows = repeats.without_repeats(table(spark, folder, "documents"), ["doc_id"])
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", periods.planted(F.col("doc_id"), F.col("text")).alias("text"))
    return periods.digests(docs, ["doc_id"])


@query
def op13_hard_negatives(spark, folder):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label=shifted)
