"""The instruction-tuning table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.functions.tokenizers import WORDS
from corpusloom.operators.labels import completion_labels
from corpusloom.operators.packing import concat_sources
from corpusloom.operators.render import chat_prompt_response
from corpusloom.operators.tokens import tokenize, truncate


def sft_dataset(
    sources: dict[str, DataFrame], keep: list[str], system: str | None = None
) -> DataFrame:
    """Rendered chat text of every source, in the order of the mapping. No shuffle."""
    return concat_sources(
        {name: chat_prompt_response(df, keep, system=system) for name, df in sources.items()}
    )


def sft_examples(
    rendered: DataFrame,
    keep: list[str],
    max_length: int,
    instruction: list,
    response: list,
    tokenizer=WORDS,
) -> DataFrame:
    """Token ids of rendered chats, cut to length, with loss on the answers only."""
    ids = truncate(tokenize(rendered, "text", keep, tokenizer), max_length)
    ids = truncate(ids, max_length, "attention_mask")
    return completion_labels(ids, instruction, response)
