"""ROUGE and BLEU over two token arrays as columns: nothing leaves the row."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.functions import text as X
from colloquy.functions.lcs import token_lcs


def multiset_overlap(left: Column, right: Column) -> Column:
    """Sum over distinct elements of the smaller of the two counts: one pass over
    both arrays sorted together."""
    start = F.struct(
        F.lit("").alias("gram"), F.lit(0).alias("l"), F.lit(0).alias("r"), F.lit(0).alias("sum")
    )
    tag = lambda xs, l, r: F.transform(
        xs, lambda g: F.struct(g.alias("gram"), F.lit(l).alias("l"), F.lit(r).alias("r"))
    )

    def step(acc, x):
        same = x["gram"] == acc["gram"]
        return F.struct(
            x["gram"].alias("gram"),
            F.when(same, acc["l"] + x["l"]).otherwise(x["l"]).alias("l"),
            F.when(same, acc["r"] + x["r"]).otherwise(x["r"]).alias("r"),
            F.when(same, acc["sum"]).otherwise(acc["sum"] + F.least(acc["l"], acc["r"])).alias("sum"),
        )

    counted = F.aggregate(
        F.sort_array(F.concat(tag(left, 1, 0), tag(right, 0, 1))),
        start,
        step,
        lambda acc: acc["sum"] + F.least(acc["l"], acc["r"]),
    )
    return F.when(F.arrays_overlap(left, right), counted).otherwise(F.lit(0))


def gram_overlaps(left: Column, right: Column, max_n: int) -> Column:
    """Array of the overlaps of 1-grams to ``max_n``-grams."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(max_n)),
        lambda n: X.let(
            F.struct(X.grams_up_to(left, n).alias("l"), X.grams_up_to(right, n).alias("r")),
            lambda g: multiset_overlap(g["l"], g["r"]),
        ),
    )


def f_measure(overlap: Column, left_total: Column, right_total: Column) -> Column:
    """Harmonic mean of precision and recall; zero without any overlap."""
    precision = overlap.cast("double") / left_total
    recall = overlap.cast("double") / right_total
    return F.when(overlap > 0, F.lit(2.0) * precision * recall / (precision + recall)).otherwise(F.lit(0.0))


def rouge_n(overlaps: Column, n: int, left_size: Column, right_size: Column) -> Column:
    return f_measure(F.get(overlaps, F.lit(n - 1)), left_size - (n - 1), right_size - (n - 1))


def rouge_l(left: Column, right: Column) -> Column:
    length = token_lcs(F.array_join(left, " "), F.array_join(right, " "))
    return f_measure(length, F.size(left), F.size(right))


def bleu(overlaps: Column, left_size: Column, right_size: Column, max_n: int = 4) -> Column:
    """Brevity penalty times the geometric mean of the precisions; any zero
    precision, also for want of tokens, makes the score zero."""
    logs = [
        F.ln(F.get(overlaps, F.lit(n - 1)).cast("double") / (left_size - (n - 1)))
        for n in range(1, max_n + 1)
    ]
    brevity = F.least(
        F.lit(1.0), F.exp(F.lit(1.0) - right_size.cast("double") / left_size)
    )
    # The longest n-grams overlap only if all shorter ones do.
    return F.when(
        F.get(overlaps, F.lit(max_n - 1)) > 0, brevity * F.exp(sum(logs[1:], logs[0]) / max_n)
    ).otherwise(F.lit(0.0))
