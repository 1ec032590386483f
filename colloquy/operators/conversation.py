"""From a table of conversation turns to pairs and prompts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions import chat
from colloquy.operators import hotkeys


# More turns than any conversation has, so that pair numbers never meet.
TURNS = 1 << 31


def pair_key(conv="conv_id", turn="turn"):
    """A number for a turn: both numbers side by side where they fit, else a negative 63-bit
    hash of both, so that hashed or negative conversation ids neither overflow nor meet the others."""
    conv, turn = F.col(conv), F.col(turn)
    fits = conv.between(0, (1 << 32) - 1) & turn.between(0, TURNS - 1)
    hashed = -1 - F.shiftrightunsigned(F.xxhash64(conv, turn), 1)
    return F.when(fits, conv * TURNS + turn).otherwise(hashed)


def adjacent_pairs(turns: DataFrame, chunk_rows: int = hotkeys.CHUNK_ROWS) -> DataFrame:
    """User turns directly followed by an assistant turn of the same conversation, as
    ``example_id, conv_id, user, assistant``."""
    key = pair_key().alias("example_id")
    if not hotkeys.large_keys(turns, "conv_id", chunk_rows):
        order = Window.partitionBy("conv_id").orderBy("turn")
        followed = turns.select(
            key, "conv_id", "role", F.col("text").alias("user"),
            F.lead("role").over(order).alias("next_role"),
            F.lead("text").over(order).alias("assistant"),
        )
        return followed.where(
            (F.col("role") == "user") & (F.col("next_role") == "assistant")
        ).select("example_id", "conv_id", "user", "assistant")
    # A conversation too long for one task: number its turns in chunks, then join
    # each user turn to the next position, a key that is never repeated.
    placed = hotkeys.add_position(turns, "conv_id", ["turn"], chunk_rows=chunk_rows)
    asked = placed.where(F.col("role") == "user").select(
        key, "conv_id", (F.col("position") + 1).alias("position"), F.col("text").alias("user")
    )
    answered = placed.where(F.col("role") == "assistant").select(
        "conv_id", "position", F.col("text").alias("assistant")
    )
    return asked.join(answered, ["conv_id", "position"]).select(
        "example_id", "conv_id", "user", "assistant"
    )


def conversation_prompts(
    turns: DataFrame, system_prompt: str | None = None, chunk_rows: int = hotkeys.CHUNK_ROWS
) -> DataFrame:
    """One open prompt per conversation.  Its turns are joined to text in chunks of about ``chunk_rows``, and
    the chunks' texts in their order, so only the prompt itself is ever as large as its conversation."""
    chunked, _ = hotkeys.add_chunks(turns.select("conv_id", "turn", "role", "text"), "conv_id", ["turn", "role", "text"], chunk_rows)
    messages = F.sort_array(
        F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))
    )
    parts = chunked.groupBy("conv_id", "chunk").agg(messages.alias("messages")).select(
        "conv_id", F.struct("chunk", chat.spoken_text(F.col("messages")).alias("text")).alias("part")
    )
    in_order = F.sort_array(F.collect_list("part"))["text"]
    return parts.groupBy("conv_id").agg(in_order.alias("parts")).select(
        "conv_id", chat.prompt_of_texts(F.col("parts"), system_prompt).alias("prompt")
    )
