"""The pretraining mixture: filter, tokenize and pack each source, then join them up."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.tokenizers import WORDS
from corpusloom.operators.packing import concat_sources, pack_text
from corpusloom.operators.quality import score_filter
from corpusloom.operators.render import instruction_prompt
from corpusloom.sources.scan import require_columns


@dataclass(frozen=True)
class CorpusSource:
    """One input of the mixture. ``order`` is its unique row key.

    ``text`` names the text column; ``score`` the quality column to filter on, if any;
    ``instruct`` marks prompt/response rows, which are rendered first. A source is read twice: for
    token counts, and for its text.
    """

    df: DataFrame
    order: str
    text: str = "content"
    score: str | None = None
    instruct: bool = False

    def prepared(self, minimum: float) -> DataFrame:
        if self.instruct:
            rows = require_columns(self.df, self.order, "prompt", "response")
            return instruction_prompt(rows, [self.order])
        rows = require_columns(self.df, self.order, self.text)
        if self.score:
            rows = score_filter(require_columns(rows, self.score), self.score, minimum)
        return rows.select(self.order, F.col(self.text).alias("text"))


def pretrain_mixture(
    sources: dict[str, CorpusSource],
    seq_len: int = 1024,
    batch_rows: int = 1024,
    minimum: float = 0.85,
    shards: int = 1,
    tokenizer=WORDS,
) -> DataFrame:
    """``(source, source_ord, batch_id, block_id, input_ids, attention_mask)``.

    Sources keep the order of the mapping. Source columns are dropped before packing. Each
    source needs a few small jobs over its keys; those of all sources run side by side.
    """

    def packed(source: CorpusSource) -> DataFrame:
        return pack_text(
            source.prepared(minimum),
            "text",
            source.order,
            seq_len,
            batch_rows,
            shards,
            tokenizer,
            mask=True,
        )

    with ThreadPoolExecutor(max_workers=max(1, len(sources))) as pool:
        blocks = list(pool.map(packed, sources.values()))
    return concat_sources(dict(zip(sources, blocks)))
