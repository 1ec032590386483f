"""Chat-format text as columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy import fixed


def block(role, content) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.concat(
        F.lit(fixed.IM_START), role, F.lit("\n"), content, F.lit("\n" + fixed.IM_END)
    )


def chat_text(user: Column, assistant: Column, system_prompt: str | None = None) -> Column:
    """System, user and assistant blocks; an empty prompt takes the default."""
    system = system_prompt or fixed.SYSTEM_PROMPT
    return F.concat_ws(
        "\n",
        block("system", F.lit(system)),
        block("user", user),
        block("assistant", assistant),
    )


def chat_prompt(user: Column, system_prompt: str | None = None) -> Column:
    """System and user blocks, then the assistant block left open."""
    system = system_prompt or fixed.SYSTEM_PROMPT
    return F.concat_ws(
        "\n",
        block("system", F.lit(system)),
        block("user", user),
        F.lit(fixed.IM_START + "assistant\n"),
    )


def spoken_text(messages: Column) -> Column:
    """Ordered ``(role, content)`` structs as blocks, without stored system turns; null where none is left."""
    role = lambda m: F.coalesce(m["role"], F.lit("user"))
    spoken = F.filter(messages, lambda m: role(m) != "system")
    blocks = F.transform(spoken, lambda m: block(role(m), F.coalesce(m["content"], F.lit(""))))
    return F.when(F.size(blocks) > 0, F.array_join(blocks, "\n"))


def conversation_prompt(messages: Column, system_prompt: str | None = None) -> Column:
    """Ordered ``(role, content)`` structs to a prompt; see ``prompt_of_texts``."""
    return prompt_of_texts(F.array(spoken_text(messages)), system_prompt)


def prompt_of_texts(parts: Column, system_prompt: str | None = None) -> Column:
    """Ordered texts of ``spoken_text`` to a prompt: stored system turns give way
    to the system prompt; only a missing prompt (not an empty one) is defaulted."""
    system = fixed.SYSTEM_PROMPT if system_prompt is None else system_prompt
    ends = F.array(block("system", F.lit(system))), F.array(F.lit(fixed.IM_START + "assistant\n"))
    return F.array_join(F.concat(ends[0], parts, ends[1]), "\n")


def category_or_unknown(category="category") -> Column:
    col = F.col(category) if isinstance(category, str) else category
    return F.coalesce(col, F.lit(fixed.UNKNOWN_CATEGORY))
