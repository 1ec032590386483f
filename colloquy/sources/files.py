"""Readers and writers of example tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy import schemas
from colloquy.functions import chat
from colloquy.operators import hotkeys


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True, **options) -> DataFrame:
    """CSV with a header.  Texts may hold line breaks, which keeps a file from being
    split; pass ``multi_line=False`` where they do not."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .options(**options)
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: T.StructType, is_jsonl: bool = False) -> DataFrame:
    """One JSON document per file (an array is rows, an object one row), or one object
    per line; only the line form can be split, so prefer it for large tables."""
    return spark.read.schema(schema).option("multiLine", not is_jsonl).json(path)


def read_directory(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.json", is_jsonl: bool = False
) -> DataFrame:
    """All files of a folder whose name matches; ``source_file, source_block, row_order``
    sort the rows as if the files were read one after the other by name."""
    return (
        spark.read.schema(schema)
        .option("multiLine", not is_jsonl)
        .option("pathGlobFilter", pattern)
        .json(folder)
        .select(
            "*",
            F.col("_metadata.file_name").alias("source_file"),
            F.col("_metadata.file_block_start").alias("source_block"),
            F.monotonically_increasing_id().alias("row_order"),
        )
    )


def in_file_order(read: DataFrame, name: str = "place") -> DataFrame:
    """Number the rows of ``read_directory`` from 1 in the order of file, block and row."""
    one = read.withColumn("_folder", F.lit(0))
    return hotkeys.add_position(one, "_folder", ["source_file", "source_block", "row_order"], name).drop("_folder")


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """JSON lines, one part per task; text is written as UTF-8."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A result of few rows by its nature (means, summaries) as one indented JSON document, its rows in
    order.  A document is one value, so tables that grow with the data belong in ``write_json``."""
    place = F.monotonically_increasing_id().alias("place")
    text = F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("json")
    rows = df.select(F.struct(place, text).alias("row")).agg(F.sort_array(F.collect_list("row"))["json"].alias("rows"))
    body = F.concat(F.lit("[\n"), F.array_join("rows", ",\n"), F.lit("\n]"))
    rows.select(body.alias("value")).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "part-*").json(path)


# --- splits -----------------------------------------------------------------------


def write_splits(split: DataFrame, path: str, system_prompt: str | None = None, mode: str = "error") -> None:
    """One table of raw columns plus the chat text, a folder per split."""
    split.select(
        "*", chat.chat_text(F.col("user"), F.col("assistant"), system_prompt).alias("text")
    ).withColumn("category", chat.category_or_unknown()).write.mode(mode).partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split; only its folder is read."""
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def text_records(examples: DataFrame, system_prompt: str | None = None, key: str = "example_id") -> DataFrame:
    """``text`` and ``category`` of every example."""
    return examples.select(
        key,
        chat.chat_text(F.col("user"), F.col("assistant"), system_prompt).alias("text"),
        chat.category_or_unknown().alias("category"),
    )


def write_formatted_copy(
    spark: SparkSession, source: str, split: str, target: str, system_prompt: str | None = None
) -> None:
    write_json(text_records(read_split(spark, source, split), system_prompt), target)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_training_text(spark: SparkSession, columnar: str, raw_json: str, system_prompt: str | None = None) -> DataFrame:
    """The columnar text table where it exists, else raw JSON lines formatted anew."""
    if _exists(spark, columnar):
        return spark.read.parquet(columnar).select("example_id", "text", "category")
    return text_records(read_json(spark, raw_json, schemas.EXAMPLES, is_jsonl=True), system_prompt)


def write_preferences(pairs: DataFrame, path: str, mode: str = "error") -> None:
    write_json(pairs.select("example_id", "prompt", "chosen", "rejected", "category"), path, mode)


def read_preferences(spark: SparkSession, path: str) -> DataFrame:
    """Prompt, chosen and rejected; the category is not read."""
    return read_json(spark, path, schemas.PREFERENCES, is_jsonl=True).select("prompt", "chosen", "rejected")
