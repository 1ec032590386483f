"""From raw documents to a training mix: filter, deduplicate, mask, mix, encode.

Each stage reads what its predecessor wrote to the shared folder, so that a lost executor costs at most one
stage's tasks.
"""

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.text import once
from colloquy.llm import bpe, curriculum, pii_bootstrap, quality_rules, simhash
from colloquy.operators import dedup
from colloquy.operators.lineage import release, scoped, settle

#: Tokens come from a regular expression and rank merges, so SQL cannot give the rows.
ORACLE_SQL = None
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Near copies: exact Jaccard similarity of the sets of so many words in a row, at least.
SHINGLE_WORDS, NEAR = 5, 0.8
#: Where a stage's intermediate tables go, until the next stage of the session begins.
SCOPE = "pipeline-stage"


def _stage(build):
    """Intermediate tables of the stage before go when a stage begins: by then its result has been
    written and is read from there.  One pipeline runs in a session at a time."""

    @wraps(build)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, SCOPE)
        with scoped(SCOPE):
            return build(spark, docs, sf_dir)

    return begin


@_stage
def _filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; null texts have no words and go.  The stop-word rule is for the
    languages whose words it knows.

    The verdict is a step of its own: pushed into the measures, the filter would repeat each of them per rule."""
    packed = docs.select(F.struct(*docs.columns).alias("row"), "text")
    lang = F.col("row.lang") if "lang" in docs.columns else None
    judged = quality_rules.judged(packed, ["row"], lang=lang).select("row", once(F.col("kept")).alias("kept"))
    return judged.where("kept").select("row.*")


@_stage
def _dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No document that is a near copy of one that stays and has a smaller doc_id; of equal keys the one stored first
    stays, documents without a key come last.

    SimHash (``op3``) comes first: rows of one fingerprint and equal words are one, rows of equal or linked fingerprints are
    compared by exact Jaccard similarity.  Fingerprints of 64 bits miss most pairs between 0.8 and 0.95, so these are then
    sought by the prefixes of their sets of words in a row."""
    return dedup.one_of_each(docs, "doc_id", "text", NEAR, SHINGLE_WORDS, copies=simhash.candidates)


@_stage
def _mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    masked = pii_bootstrap.masked(docs)
    if "n_chars" not in docs.columns:
        return masked
    changed = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", changed)


@_stage
def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in the order of training."""
    return curriculum.in_training_order(docs)


@_stage
def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix: doc_id, source, n_tokens, ids."""
    path = public_tokenizers.path(VOCABULARY)
    rows = bpe.encode(docs, path, public_tokenizers.PATTERN, ["doc_id", "source"])
    return rows.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", _filter),
    ("exact_near_dedup", _dedup),
    ("pii_masking", _mask),
    ("source_mix", _mix),
    ("bpe_encode", _encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; an empty table gives an empty result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
