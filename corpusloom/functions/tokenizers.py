"""Tokenizer choices for every operator that counts, packs or encodes text.

``WordTokenizer`` and ``ByteTokenizer`` are Spark expressions. ``ExternalTokenizer``
is the slot for a trained vocabulary: a loader that runs once per Python task and
returns a function from a list of texts to a list of id lists, fed Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import as_column

# Runs of anything but blank, tab, newline and carriage return. Means the same in
# Java and RE2, which \s and \p{..} do not.
WORD_PATTERN = r"[^ \t\n\r]+"


@dataclass(frozen=True)
class WordTokenizer:
    """Tokens are the strings matched by ``pattern``."""

    pattern: str = WORD_PATTERN
    element_type: str = "string"

    def tokens(self, c: Column | str) -> Column:
        return F.regexp_extract_all(as_column(c), F.lit(self.pattern), F.lit(0))

    def count(self, c: Column | str) -> Column:
        return F.array_size(self.tokens(c))


@dataclass(frozen=True)
class ByteTokenizer:
    """Token ids are the UTF-8 byte values 0-255."""

    element_type: str = "int"

    def tokens(self, c: Column | str) -> Column:
        # Cutting the hex form in pairs is linear; substring by position is not.
        pairs = F.regexp_extract_all(F.hex(F.encode(as_column(c), "utf-8")), F.lit(".."), F.lit(0))
        return F.transform(pairs, lambda h: F.conv(h, 16, 10).cast("int"))

    def count(self, c: Column | str) -> Column:
        return F.octet_length(as_column(c))


def _batch_udf(load: Callable, return_type: str) -> Callable[[Column], Column]:
    """A UDF that loads once per task and skips null texts."""

    @F.pandas_udf(return_type)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        apply = load()
        for texts in batches:
            present = texts.notna()
            results = iter(apply(texts[present].tolist()))
            yield pd.Series([next(results) if p else None for p in present], dtype=object)

    return run


@dataclass(frozen=True)
class ExternalTokenizer:
    """Ids from any Python tokenizer, one Arrow batch at a time.

    ``load_counter`` is an optional cheaper way to the number of tokens, so that counting
    sends back one number per text.
    """

    load: Callable[[], Callable[[list[str]], list[list[int]]]]
    load_counter: Callable[[], Callable[[list[str]], list[int]]] | None = None
    element_type: str = "int"

    def tokens(self, c: Column | str) -> Column:
        return _batch_udf(self.load, "array<int>")(as_column(c))

    def count(self, c: Column | str) -> Column:
        load = self.load

        def count_ids():
            encode = load()
            return lambda texts: [len(ids) for ids in encode(texts)]

        return _batch_udf(self.load_counter or count_ids, "int")(as_column(c))


def bpe_from_json(definition: str, add_special_tokens: bool = False) -> ExternalTokenizer:
    """Tokenizer from the text of a ``tokenizer.json`` file (needs ``tokenizers``).

    The definition travels inside the task closure, so executors need no file.
    """

    def encode_batch():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        # The fast form leaves out character offsets.
        run = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        return lambda texts: run(texts, add_special_tokens=add_special_tokens)

    def load():
        run = encode_batch()
        return lambda texts: [e.ids for e in run(texts)]

    def load_counter():
        run = encode_batch()
        return lambda texts: [len(e) for e in run(texts)]

    return ExternalTokenizer(load, load_counter)


WORDS = WordTokenizer()
BYTES = ByteTokenizer()
