"""ChatML rendering as string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let
from corpusloom.functions.text import as_column

# ChatML markup and the empty reasoning block.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
EMPTY_THINK = "<think>\n\n</think>\n\n"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def render_turn(role: Column, content: Column, think: Column | bool = False) -> Column:
    """One rendered message; ``think`` marks where the empty think block goes."""
    opening = F.when(think, F.lit(EMPTY_THINK)).otherwise(F.lit("")) if isinstance(
        think, Column
    ) else F.lit(EMPTY_THINK if think else "")
    return F.concat(F.lit(TURN_START), role, F.lit("\n"), opening, content, F.lit(TURN_END + "\n"))


def render_messages(messages: Column | str, think_on_last: bool = True) -> Column:
    """``array<struct<role, content>>`` to text. With ``think_on_last`` a final
    assistant message carries the empty think block, earlier ones never do."""

    def render(msgs: Column) -> Column:
        last = F.array_size(msgs) - 1

        def one(m, i):
            think = (m["role"] == "assistant") & (i == last) if think_on_last else False
            return render_turn(m["role"], m["content"], think)

        # array_join skips nulls; a message without content must not vanish silently.
        return let(
            F.transform(msgs, one),
            lambda parts: F.when(~F.exists(parts, lambda p: p.isNull()), F.array_join(parts, "")),
        )

    return let(as_column(messages), render)


def generation_prompt(messages: Column | str, thinking: bool = True) -> Column:
    """Messages plus an opened assistant turn, the inference form."""
    tail = f"{TURN_START}assistant\n" + ("" if thinking else EMPTY_THINK)
    return F.concat(render_messages(messages, think_on_last=False), F.lit(tail))


def with_system(messages: Column, system: str | None) -> Column:
    """Prepend a system message; ``None`` leaves the messages alone."""
    if system is None:
        return messages
    return F.concat(F.array(message("system", F.lit(system))), messages)
