"""Preference pairs from examples."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.functions import chat, picks

# Each strategy turns the chosen answer into a rejected one.  The built-in ones give
# a set answer whatever the chosen one is.
REJECTIONS = {
    name: (lambda chosen, answer=answer: F.lit(answer))
    for name, answer in fixed.REJECTED_ANSWERS.items()
}


def preference_pairs(
    examples: DataFrame,
    seed: int | Column = 42,
    system_prompt: str | None = None,
    rejections=None,
    key: str = "example_id",
) -> DataFrame:
    """``prompt, chosen, rejected, category`` per example; the strategy is a seeded
    pick by the example's key."""
    strategies = list((rejections or REJECTIONS).values())
    choice = picks.pick(len(strategies), seed, F.col(key))
    rejected = F.get(F.array(*[s(F.col("assistant")) for s in strategies]), choice)
    end = F.lit("\n" + fixed.IM_END)
    return examples.select(
        key,
        *(["split"] if "split" in examples.columns else []),
        chat.chat_prompt(F.col("user"), system_prompt).alias("prompt"),
        F.concat("assistant", end).alias("chosen"),
        F.concat(rejected, end).alias("rejected"),
        chat.category_or_unknown().alias("category"),
    )


def preference_splits(split: DataFrame, seeds: dict[str, int] | None = None) -> DataFrame:
    """Pairs for the train and validation splits, each with its own seed; other
    splits get none."""
    seeds = seeds or fixed.PREFERENCE_SEEDS
    seed = F.lit(None).cast("string")
    for name, value in seeds.items():
        seed = F.when(F.col("split") == name, F.lit(str(value))).otherwise(seed)
    return preference_pairs(split.where(F.col("split").isin(list(seeds))), seed)
