"""Answer evaluation: row metrics, their means, and before/after comparison."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.functions import checks
from colloquy.functions.chat import category_or_unknown
from colloquy.operators.textmetrics import add_text_metrics

OVERALL = ["rouge_1", "rouge_2", "rouge_l", "bleu", "keyword_coverage", "format_compliance"]
BY_CATEGORY = ["rouge_l", "bleu", "keyword_coverage", "format_compliance"]


def align(predictions: DataFrame, references: DataFrame, key: str = "example_id") -> DataFrame:
    """Join both sides on the key; any key without its partner fails the job that reads the rows."""
    both = references.withColumn("_r", F.lit(True)).join(predictions.withColumn("_p", F.lit(True)), key, "full")
    lost = F.raise_error(F.lit("a row has a prediction or a reference only"))
    return both.where(F.when(F.col("_r") & F.col("_p"), F.lit(True)).otherwise(lost)).drop("_r", "_p")


def row_metrics(df: DataFrame) -> DataFrame:
    """``prediction, reference, category?`` to the six scores of every row."""
    category = category_or_unknown() if "category" in df.columns else F.lit(fixed.UNKNOWN_CATEGORY)
    scored = df.withColumn("category", category).withColumns(
        {
            "keyword_coverage": checks.keyword_coverage(F.col("prediction"), F.col("category"))["score"],
            "format_compliance": checks.format_compliance(F.col("prediction"))["score"],
        }
    )
    return add_text_metrics(scored)


def _means(names):
    return [F.avg(m).alias(m) for m in names] + [F.count(F.lit(1)).alias("num_examples")]


def overall_metrics(rows: DataFrame, by=()) -> DataFrame:
    return rows.groupBy(*by).agg(*_means(OVERALL))


def category_metrics(rows: DataFrame, by=()) -> DataFrame:
    return rows.groupBy(*by, "category").agg(*_means(BY_CATEGORY))


def all_metrics(rows: DataFrame) -> DataFrame:
    """Overall and per category from one pass; the overall row has no category."""
    return rows.rollup("category").agg(
        F.when(F.grouping("category") == 1, "overall").otherwise("category").alias("level"),
        *_means(OVERALL),
    )


def self_evaluation(examples: DataFrame) -> DataFrame:
    """Reference answers scored against themselves."""
    return row_metrics(
        examples.withColumns({"prediction": F.col("assistant"), "reference": F.col("assistant")})
    )


def constant_baseline(examples: DataFrame, answer: str = fixed.GENERIC_ANSWER) -> DataFrame:
    """One generic answer scored against every reference."""
    return row_metrics(
        examples.withColumns({"prediction": F.lit(answer), "reference": F.col("assistant")})
    )


def before_after_rows(
    examples: DataFrame, baseline: DataFrame, finetuned: DataFrame, key: str = "example_id"
) -> DataFrame:
    """Each example with the answers of both models; a missing answer is ``N/A``."""
    side = lambda df, name: df.select(key, F.col("prediction").alias(name))
    missing = F.lit("N/A")
    return (
        examples.join(side(baseline, "baseline_response"), key, "left")
        .join(side(finetuned, "finetuned_response"), key, "left")
        .select(
            key,
            "user",
            category_or_unknown().alias("category"),
            F.col("assistant").alias("reference"),
            F.coalesce("baseline_response", missing).alias("baseline_response"),
            F.coalesce("finetuned_response", missing).alias("finetuned_response"),
        )
    )


def before_after_metrics(compared: DataFrame) -> DataFrame:
    """Row metrics of both models under a ``model`` column, from one pass over the
    compared rows."""
    models = F.explode(
        F.array(
            F.struct(F.lit("baseline").alias("model"), F.col("baseline_response").alias("prediction")),
            F.struct(F.lit("finetuned").alias("model"), F.col("finetuned_response").alias("prediction")),
        )
    )
    return row_metrics(
        compared.select("example_id", "category", "reference", models.alias("m")).select(
            "example_id", "category", "reference", "m.*"
        )
    )


def metric_deltas(rows: DataFrame) -> DataFrame:
    """Per metric the mean of both models and the difference."""
    return _deltas(rows, [], OVERALL)


def category_deltas(rows: DataFrame) -> DataFrame:
    """The same for each category."""
    return _deltas(rows, ["category"], BY_CATEGORY)


def _deltas(rows: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    means = rows.groupBy("model", *by).agg(*[F.avg(m).alias(m) for m in names])
    long = means.select(
        "model", *by,
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names])).alias("x"),
    ).select("model", *by, "x.*")
    return (
        long.groupBy(*by, "metric")
        .pivot("model", ["baseline", "finetuned"])
        .agg(F.first("value"))
        .withColumn("delta", F.col("finetuned") - F.col("baseline"))
    )


def category_report(rows: DataFrame) -> DataFrame:
    """Per-category means with four decimals, sorted by name."""
    means = category_metrics(rows)
    return means.select(
        "category", *[F.round(m, 4).alias(m) for m in BY_CATEGORY], "num_examples"
    ).orderBy("category")


def first_comparisons(compared: DataFrame, n: int = 5, key: str = "example_id") -> DataFrame:
    return compared.orderBy(key).limit(n)
