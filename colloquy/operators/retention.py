"""Knowledge retention: multiple-choice accuracy before and after training."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy import fixed, schemas
from colloquy.functions.chat import category_or_unknown


def knowledge_items(spark: SparkSession) -> DataFrame:
    """The built-in questions."""
    return spark.createDataFrame(
        [(i, q, c, a, k) for i, (q, c, a, k) in enumerate(fixed.KNOWLEDGE_ITEMS)], schemas.KNOWLEDGE
    )


def item_prompt(question: Column, choices: Column) -> Column:
    lines = [F.concat(F.lit("Question: "), question)]
    for i, letter in enumerate(fixed.CHOICE_LETTERS):
        lines.append(F.concat(F.lit(f"{letter}) "), F.get(choices, F.lit(i))))
    return F.concat_ws("\n", *lines, F.lit("Answer:"))


def predicted_choice(scores: DataFrame, by=("model", "question_id")) -> DataFrame:
    """The choice of highest score per question, the first one on ties."""
    best = F.max_by("choice_idx", F.struct("score", (-F.col("choice_idx")).alias("tie")))
    return scores.groupBy(*by).agg(best.cast("int").alias("predicted"))


def graded(predictions: DataFrame, items: DataFrame) -> DataFrame:
    letters = F.array(*[F.lit(x) for x in fixed.CHOICE_LETTERS])
    return predictions.join(items, "question_id").select(
        *[c for c in ("model", "question_id", "question") if c in predictions.columns + items.columns],
        F.get(letters, F.col("predicted")).alias("predicted"),
        F.get(letters, F.col("answer")).alias("correct_answer"),
        (F.col("predicted") == F.col("answer")).alias("is_correct"),
        category_or_unknown().alias("category"),
    )


def _accuracy():
    correct = F.count_if("is_correct")
    total = F.count(F.lit(1))
    return [
        correct.alias("correct"),
        total.alias("total"),
        F.coalesce(F.try_divide(correct.cast("double"), total.cast("double")), F.lit(0.0)).alias("accuracy"),
    ]


def accuracy_by_category(details: DataFrame) -> DataFrame:
    return details.groupBy("model", "category").agg(*_accuracy())


def overall_accuracy(details: DataFrame) -> DataFrame:
    return details.groupBy("model").agg(*_accuracy())


def _one_side(accuracy: DataFrame, model: str, name: str, by: list[str]) -> DataFrame:
    return accuracy.where(F.col("model") == model).select(*by, F.col("accuracy").alias(name))


def compare_categories(accuracy: DataFrame, base="baseline", tuned="finetuned") -> DataFrame:
    """All categories of either side; an absent side counts as zero."""
    zero = F.lit(0.0)
    both = _one_side(accuracy, base, "baseline", ["category"]).join(
        _one_side(accuracy, tuned, "finetuned", ["category"]), "category", "full"
    )
    return both.select(
        "category",
        F.coalesce("baseline", zero).alias("baseline"),
        F.coalesce("finetuned", zero).alias("finetuned"),
    ).withColumn("drop", F.col("baseline") - F.col("finetuned"))


def severity(relative_drop: Column) -> Column:
    return (
        F.when(relative_drop <= 0, "none")
        .when(relative_drop < fixed.MINIMAL_DROP, "minimal")
        .when(relative_drop < fixed.MODERATE_DROP, "moderate")
        .otherwise("significant")
    )


def forgetting(overall: DataFrame, base="baseline", tuned="finetuned") -> DataFrame:
    """One row: both accuracies, absolute and relative drop, severity and message."""
    side = lambda model: F.coalesce(
        F.max(F.when(F.col("model") == model, F.col("accuracy"))), F.lit(0.0)
    )
    drops = overall.agg(
        side(base).alias("baseline_accuracy"), side(tuned).alias("finetuned_accuracy")
    ).withColumn("absolute_drop", F.col("baseline_accuracy") - F.col("finetuned_accuracy"))
    relative = F.when(
        F.col("baseline_accuracy") > 0, F.col("absolute_drop") / F.col("baseline_accuracy")
    ).otherwise(F.lit(0.0))
    level = severity(F.col("relative_drop"))
    message = F.lit(None).cast("string")
    for name, text in fixed.SEVERITY_MESSAGES.items():
        message = F.when(F.col("severity") == name, text).otherwise(message)
    return (
        drops.withColumn("relative_drop", relative)
        .withColumn("severity", level)
        .withColumn("message", message)
        .withColumn("threshold_5pct", F.col("relative_drop") < fixed.MINIMAL_DROP)
    )


def forgetting_report(details: DataFrame) -> DataFrame:
    """The comparison overall (no category), with severity and message, and per category."""
    overall = forgetting(overall_accuracy(details)).select(
        F.lit(None).cast("string").alias("category"), F.col("baseline_accuracy").alias("baseline"),
        F.col("finetuned_accuracy").alias("finetuned"), F.col("absolute_drop").alias("drop"),
        "relative_drop", "severity", "message", "threshold_5pct",
    )
    return overall.unionByName(compare_categories(accuracy_by_category(details)), allowMissingColumns=True)
