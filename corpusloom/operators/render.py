"""Prompt and chat rendering: each operator adds ``text`` and keeps only ``keep``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import chatml
from corpusloom.functions.text import python_text, str_strip


def _project(df: DataFrame, keep: list[str], text: Column) -> DataFrame:
    return df.select(*keep, text.alias("text"))


def _chat(df, keep, messages, system, think_on_last):
    messages = chatml.with_system(messages, system)
    return _project(df, keep, chatml.render_messages(messages, think_on_last))


def _exchange(user: Column, assistant: Column) -> Column:
    return F.array(chatml.message("user", user), chatml.message("assistant", assistant))


def instruction_prompt(
    df: DataFrame, keep: list[str], prompt: str = "prompt", response: str = "response"
) -> DataFrame:
    """The plain instruction form; edges are kept and null prints as ``None``."""
    return _project(
        df,
        keep,
        F.concat(
            F.lit("### Instruction:\n"),
            python_text(prompt),
            F.lit("\n### Response:\n"),
            python_text(response),
        ),
    )


def chat_prompt_response(
    df: DataFrame,
    keep: list[str],
    prompt: str = "prompt",
    response: str = "response",
    system: str | None = None,
    think_on_last: bool = True,
) -> DataFrame:
    """One user/assistant exchange, both sides stripped."""
    return _chat(df, keep, _exchange(str_strip(prompt), str_strip(response)), system, think_on_last)


def chat_input_target(
    df: DataFrame, keep: list[str], system: str | None = None, think_on_last: bool = True
) -> DataFrame:
    """The same exchange from columns ``input`` and ``target``."""
    return chat_prompt_response(df, keep, "input", "target", system, think_on_last)


def chat_first_exchange(
    df: DataFrame,
    keep: list[str],
    conversations: str = "conversations",
    system: str | None = None,
    strict: bool = True,
    think_on_last: bool = True,
) -> DataFrame:
    """First two ``value`` entries as an exchange, not stripped, later ones ignored.

    ``strict`` fails on a conversation with fewer than two entries; otherwise its
    ``text`` is null and :func:`unrendered` collects it.
    """
    c = F.col(conversations)
    pair = _exchange(F.get(c, F.lit(0))["value"], F.get(c, F.lit(1))["value"])
    if strict:
        short = F.raise_error(F.lit("a conversation needs two entries"))
        pair = F.when(F.array_size(c) >= 2, pair).otherwise(
            short.cast("array<struct<role: string, content: string>>")
        )
    return _chat(df, keep, pair, system, think_on_last)


def unrendered(df: DataFrame) -> DataFrame:
    """Rows a lenient renderer could not turn into text."""
    return df.where(F.col("text").isNull())


def chat_multi_turn(
    df: DataFrame,
    keep: list[str],
    conversation: str = "conversation",
    system: str | None = None,
    think_on_last: bool = True,
) -> DataFrame:
    """Every ``{human, assistant}`` item as two stripped messages."""
    pairs = F.transform(
        conversation, lambda t: _exchange(str_strip(t["human"]), str_strip(t["assistant"]))
    )
    return _chat(df, keep, F.flatten(pairs), system, think_on_last)


def chat_instruction_input(
    df: DataFrame,
    keep: list[str],
    instruction: str = "instruction",
    extra: str = "input",
    output: str = "output",
    system: str | None = None,
    think_on_last: bool = True,
) -> DataFrame:
    """User content is instruction, newline, input; the newline stays if input is empty."""
    user = F.concat(str_strip(instruction), F.lit("\n"), str_strip(extra))
    return _chat(df, keep, _exchange(user, str_strip(output)), system, think_on_last)


def generation_prompt(
    df: DataFrame,
    keep: list[str],
    prompt: str = "prompt",
    system: str | None = None,
    thinking: bool = True,
) -> DataFrame:
    """A user prompt with the assistant turn left open."""
    messages = chatml.with_system(F.array(chatml.message("user", F.col(prompt))), system)
    return _project(df, keep, chatml.generation_prompt(messages, thinking))
