"""Similarity metrics of prediction and reference, row by row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions import similarity as S
from colloquy.functions import text as X

TEXT_METRICS = ["rouge_1", "rouge_2", "rouge_l", "bleu"]


def add_text_metrics(
    df: DataFrame, prediction="prediction", reference="reference", metrics=TEXT_METRICS, max_n: int = 4
) -> DataFrame:
    """Add the named metrics.  No shuffle: tokens and n-gram counts stay in the row,
    and only the longest common subsequence leaves the JVM."""
    longest = max_n if "bleu" in metrics else 2
    tokens = F.struct(
        X.lower_words(X.text_or_empty(prediction)).alias("p"),
        X.lower_words(X.text_or_empty(reference)).alias("r"),
    )
    with_tokens = df.select("*", X.once(tokens).alias("_t"))
    p, r = F.col("_t.p"), F.col("_t.r")
    if set(metrics) - {"rouge_l"}:
        with_tokens = with_tokens.select("*", X.once(S.gram_overlaps(p, r, longest)).alias("_o"))
    made = {
        "rouge_1": lambda: S.rouge_n(F.col("_o"), 1, F.size(p), F.size(r)),
        "rouge_2": lambda: S.rouge_n(F.col("_o"), 2, F.size(p), F.size(r)),
        "rouge_l": lambda: S.rouge_l(p, r),
        "bleu": lambda: S.bleu(F.col("_o"), F.size(p), F.size(r), max_n),
    }
    return with_tokens.select(*df.columns, *[made[m]().alias(m) for m in metrics])
