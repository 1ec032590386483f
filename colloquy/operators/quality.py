"""Quality filter and its summary."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.functions.quality import quality_score
from colloquy.functions.text import once


def score_examples(df: DataFrame) -> DataFrame:
    """Add ``quality``, computed once however often it is used above."""
    return df.select("*", once(quality_score()).alias("quality"))


def filter_quality(df: DataFrame, min_quality: float = fixed.MIN_QUALITY) -> DataFrame:
    return score_examples(df).where(F.col("quality") >= F.lit(float(min_quality)))


def quality_summary(df: DataFrame, min_quality: float = fixed.MIN_QUALITY) -> DataFrame:
    """Mean score over all rows, and how many the filter keeps and removes."""
    kept = F.col("quality") >= F.lit(float(min_quality))
    return score_examples(df).agg(
        F.avg("quality").alias("mean_quality"),
        F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("removed"),
    )
