"""The offline evaluation run: references against themselves and a constant answer."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.operators import retention, taskmetrics
from colloquy.operators.lineage import settle
from colloquy.sources import files


@dataclass
class Evaluation:
    self_metrics: DataFrame
    baseline_metrics: DataFrame
    comparisons: DataFrame


def evaluate_offline(examples: DataFrame, folder: str | None = None) -> Evaluation:
    """Metrics overall and per category of both runs; with ``folder`` also stored as
    small reports."""
    own = taskmetrics.all_metrics(taskmetrics.self_evaluation(examples))
    generic = taskmetrics.all_metrics(taskmetrics.constant_baseline(examples))
    first = taskmetrics.first_comparisons(
        examples.select(
            "example_id", "user", "category", F.col("assistant").alias("reference"),
            F.lit(fixed.GENERIC_ANSWER).alias("baseline_response"),
            F.lit("N/A").alias("finetuned_response"),
        )
    )
    if folder:
        own, generic = settle(own, "metrics"), settle(generic, "metrics")
        files.write_report(own, f"{folder}/self_metrics")
        files.write_report(generic, f"{folder}/baseline_metrics")
        files.write_report(first, f"{folder}/comparisons")
    return Evaluation(own, generic, first)


def evaluate_models(
    examples: DataFrame, baseline: DataFrame, finetuned: DataFrame, folder: str | None = None
) -> Evaluation:
    """Both models' answers against the references; the row-level table is stored in
    full, the means as small reports."""
    compared = taskmetrics.before_after_rows(examples, baseline, finetuned)
    rows = settle(taskmetrics.before_after_metrics(compared), "scored")
    side = lambda model: taskmetrics.all_metrics(rows.where(F.col("model") == model))
    if folder:
        files.write_json(compared, f"{folder}/predictions")
        files.write_report(side("finetuned"), f"{folder}/finetuned_metrics")
        files.write_report(side("baseline"), f"{folder}/baseline_metrics")
    return Evaluation(side("finetuned"), side("baseline"), taskmetrics.first_comparisons(compared))


def full_report(compared: DataFrame, details: DataFrame, folder: str) -> None:
    """Everything about a training run in three small reports under ``folder``: ``task_metrics`` before and after, overall and per
    category, ``forgetting`` on the multiple-choice items, and the first ``comparisons``."""
    rows = settle(taskmetrics.before_after_metrics(compared), "scored")
    overall = taskmetrics.metric_deltas(rows).withColumn("category", F.lit(None).cast("string"))
    files.write_report(overall.unionByName(taskmetrics.category_deltas(rows)), f"{folder}/task_metrics")
    files.write_report(retention.forgetting_report(details), f"{folder}/forgetting")
    files.write_report(taskmetrics.first_comparisons(compared), f"{folder}/comparisons")
