"""The row-local steps on a stream of examples.  No state and no watermark: each row
is masked, scored, filtered and formatted by itself, as in a batch."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.operators.pii import mask_fields
from colloquy.operators.quality import filter_quality
from colloquy.sources.files import text_records


def clean_rows(examples: DataFrame, min_quality: float = fixed.MIN_QUALITY, system_prompt: str | None = None) -> DataFrame:
    masked = mask_fields(examples).select(*examples.columns)
    return text_records(filter_quality(masked, min_quality), system_prompt)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what has arrived and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
