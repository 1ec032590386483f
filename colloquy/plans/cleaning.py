"""Mask, deduplicate and filter examples, with the counts after every stage."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.functions.quality import reaches
from colloquy.functions.text import once
from colloquy.operators import dedup, pii
from colloquy.operators.lineage import settle


@dataclass
class Cleaned:
    examples: DataFrame
    funnel: DataFrame
    pii_found: DataFrame


def clean(
    examples: DataFrame,
    mask_pii: bool = True,
    remove_duplicates: bool = True,
    filter_by_quality: bool = True,
    dedup_threshold: float = fixed.DEDUP_THRESHOLD,
    min_quality: float = fixed.MIN_QUALITY,
) -> Cleaned:
    """Each stage can be switched off; it then reports the rows it was given.  The masked and the kept rows are
    written once, and the counts are taken while they are."""
    spark, one = examples.sparkSession, F.lit(1)
    given, left = Observation(), Observation()
    masked = pii.mask_fields(examples) if mask_pii else examples
    masked = settle(masked.observe(given, F.count(one).alias("n")), "masked")
    found = (
        pii.pii_totals(masked)
        if mask_pii
        else spark.createDataFrame([], "field string, pii_type string, n long")
    )
    plain = masked.select(*examples.columns)
    unique = dedup.deduplicate_examples(plain, dedup_threshold) if remove_duplicates else plain
    keep = reaches(min_quality) if filter_by_quality else F.lit(True)
    judged = unique.select(F.struct(*examples.columns).alias("row"), once(keep).alias("keep"))
    judged = judged.observe(left, F.count(one).alias("n_unique"), F.count_if("keep").alias("n_kept"))
    kept = settle(judged.where("keep").select("row.*"), "kept")
    # Masking drops no row, so the first two stages have one count.
    stages = [
        ("original_count", given.get["n"]),
        ("after_pii_masking", given.get["n"]),
        ("after_deduplication", left.get["n_unique"]),
        ("after_quality_filtering", left.get["n_kept"]),
    ]
    return Cleaned(kept, spark.createDataFrame(stages, "stage string, n long"), found)


def retention_rate(funnel: DataFrame) -> DataFrame:
    """Percent of the rows that are left; null for an empty input."""
    at = lambda stage: F.max(F.when(F.col("stage") == stage, F.col("n")))
    return funnel.agg(
        F.try_divide(
            at("after_quality_filtering") * F.lit(100.0), at("original_count").cast("double")
        ).alias("retention_rate")
    )
