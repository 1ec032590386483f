"""Preference formatting: a chosen and a rejected conversation as one prompt and two masked completions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The chat markup.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Turns joined into one output row.
CHUNK = 1_000


def turns(df: DataFrame, conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """``conv, turn, role, text``, one row per conversation and turn number.

    Rows without conversation or turn number take no part; a missing role is ``user``, a missing
    text empty; of rows with one number that of the smallest role, then text, counts."""
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.struct(F.coalesce(F.col(role), F.lit("user")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("said"),
    ).where("conv is not null and turn is not null")
    return rows.groupBy("conv", "turn").agg(F.min("said").alias("said")).select("conv", "turn", "said.*")


def with_other_answers(rows: DataFrame) -> DataFrame:
    """Pairs from a table of turns: ``pair, turn, chosen, rejected`` (structs of role and text, null where that side
    has no turn of the number).

    Every conversation with an assistant turn is chosen once; its rejected version says, in its last assistant turn,
    what the conversation of the next number says in its own (nothing, if that has none), and
    ends there.  Conversations must be whole numbers; for ids of another type, which have no next one, give both sides
    to ``paired``."""
    if not isinstance(rows.schema["conv"].dataType, T.IntegralType):
        raise TypeError(f"no next conversation for ids of {rows.schema['conv'].dataType.simpleString()}; use paired()")
    last = rows.where("role = 'assistant'").groupBy("conv").agg(
        F.max("turn").alias("at"), F.max_by("text", "turn").alias("answer")
    )
    other = last.select((F.col("conv") - 1).alias("conv"), F.col("answer").alias("other"))
    ends = last.select("conv", "at").join(other, "conv", "left")
    said = F.struct("role", "text")
    instead = F.struct("role", F.coalesce("other", F.lit("")).alias("text"))
    return rows.join(ends, "conv").select(
        F.col("conv").alias("pair"), "turn", said.alias("chosen"),
        F.when(F.col("turn") < F.col("at"), said).when(F.col("turn") == F.col("at"), instead).alias("rejected"),
    )


def paired(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Pairs from two tables of turns, by the same conversation id, of any type: as ``with_other_answers``."""
    side = lambda d, name: d.select(F.col("conv").alias("pair"), "turn", F.struct("role", "text").alias(name))
    return side(chosen, "chosen").join(side(rejected, "rejected"), ["pair", "turn"], "full")


def _rendered(said: Column) -> Column:
    return F.concat(F.lit(OPEN), said["role"], F.lit("\n"), said["text"], F.lit(CLOSE + "\n"))


def formatted(pairs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``pair, part, chunk, n_turns, text, mask`` from ``pair, turn, chosen, rejected``.

    The turns before the first number at which the two differ are the prompt, rendered once; what follows
    is rendered for either side: ``part`` is prompt, chosen or rejected.  ``mask`` lists
    the stretches of ``text`` to train on, start and end in code points: what an
    assistant says with its end mark, in completions only.  A part with no turns has no row.  Long parts are cut
    every ``chunk`` turn numbers, so that no row or task holds a whole conversation of any
    length; a part's text is its chunks joined in order."""
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    first = pairs.groupBy("pair").agg(F.min(F.when(differs, F.col("turn"))).alias("first"))
    rows = pairs.join(first, "pair")
    common = F.col("first").isNull() | (F.col("turn") < F.col("first"))
    part = lambda name, said: F.struct(F.lit(name).alias("part"), said.alias("said"))
    parts = F.when(common, F.array(part("prompt", F.col("chosen")))).otherwise(
        F.array(part("chosen", F.col("chosen")), part("rejected", F.col("rejected")))
    )
    lines = rows.select("pair", "turn", F.explode(parts).alias("p")).where("p.said is not null")
    trained = (F.col("p.part") != "prompt") & (F.col("p.said.role") == "assistant")
    grouped = (
        lines.groupBy("pair", F.col("p.part").alias("part"), F.floor(F.col("turn") / chunk).cast("long").alias("chunk"))
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "turn", _rendered(F.col("p.said")).alias("line"), trained.alias("train"),
                        (F.length(F.col("p.said.role")) + len(OPEN) + 1).alias("head"),
                    )
                )
            ).alias("lines")
        )
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))
    step = lambda a, x: F.struct(
        (a["at"] + F.length(x["line"])).alias("at"),
        F.when(
            x["train"],
            F.array_append(a["mask"], F.struct((a["at"] + x["head"]).alias("start"), (a["at"] + F.length(x["line"]) - 1).alias("end"))),
        ).otherwise(a["mask"]).alias("mask"),
    )
    return grouped.select(
        "pair", "part", "chunk", F.size("lines").cast("long").alias("n_turns"),
        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text"),
        F.aggregate("lines", start, step, lambda a: a["mask"]).alias("mask"),
    )


def mask_text(mask: Column) -> Column:
    """Stretches as start:end, comma-joined."""
    return F.array_join(F.transform(mask, lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
