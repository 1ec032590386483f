"""The data-preparation run: generate, clean, split, store, pair."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import generate, preference, split
from colloquy.operators.lineage import settle
from colloquy.plans.cleaning import Cleaned, clean
from colloquy.sources import files


def generate_examples(spark: SparkSession, total: int, seed: int = 42, **kwargs) -> DataFrame:
    return settle(generate.shuffled(generate.hybrid(spark, total, seed=seed, **kwargs), seed), "examples")


def prepare(examples: DataFrame, folder: str, system_prompt: str | None = None, seed: int = 42, **cleaning) -> Cleaned:
    """Clean the examples, cut exact splits, and store the cleaned table, splits and preference pairs
    under ``folder``."""
    cleaned = clean(examples, **cleaning)
    kept = cleaned.examples
    files.write_json(kept, f"{folder}/cleaned")
    labelled = split.exact_split(kept, seed=seed)
    files.write_splits(labelled, f"{folder}/splits", system_prompt)
    pairs = preference.preference_splits(labelled)
    for name in ("train", "validation"):
        files.write_preferences(pairs.where(F.col("split") == name), f"{folder}/{name}_preferences")
    return Cleaned(kept, cleaned.funnel, cleaned.pii_found)
