"""Fixed-length packing of token lists and the ordered union of sources.

Per batch of consecutive rows: lay the token lists end to end, cut every ``seq_len``
tokens, drop the remainder. A batch shorter than ``seq_len`` gives one short block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.tokenizers import WORDS
from corpusloom.operators.ordering import MAX_SEGMENTS, Segments, plan_segments


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def _cut(placed: DataFrame, plan: Segments, columns: list[str], seq_len: int) -> DataFrame:
    """Blocks of rows that carry ``segment``, ``batch_id`` and ``start``, the tokens before them in their batch.

    The rows are hashed on ``segment`` already, so the grouping adds no exchange. Only
    batches split over segments have to meet again in their blocks.
    """
    n = F.coalesce(F.array_size(columns[0]), F.lit(0)).cast("bigint")
    filled = placed.withColumn("_end", F.col("start") + n).where(F.col("_end") > F.col("start"))
    # One row per block a list touches, and the part of the list that falls into it. The
    # slice is taken in the generated loop that explodes, so a long list is read in place
    # and each element copied once.
    touched = F.sequence(_div(F.col("start"), seq_len), _div(F.col("_end") - 1, seq_len))
    lo = F.greatest(F.col("start"), F.col("block_id") * seq_len)
    hi = F.least(F.col("_end"), (F.col("block_id") + 1) * seq_len)
    first, length = (lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int")
    pieces = filled.select(
        *plan.batch_keys, "start", "_end", *columns, F.explode(touched).alias("block_id")
    ).select(
        *plan.batch_keys,
        "block_id",
        F.struct(lo.alias("from"), *[F.slice(c, first, length).alias(c) for c in columns]).alias("piece"),
    )
    # At most seq_len pieces meet in one block.
    blocks = pieces.groupBy(*plan.batch_keys, "block_id").agg(
        F.array_sort(F.collect_list("piece")).alias("_pieces")
    )
    joined = [F.flatten(F.col(f"_pieces.{c}")).alias(c) for c in columns]
    # Only a batch's first block may be short: then it is all the batch has.
    return blocks.select("batch_id", "block_id", *joined).where(
        (F.array_size(columns[0]) == seq_len) | (F.col("block_id") == 0)
    )


def _starts(plan: Segments) -> DataFrame:
    return plan.places.select("segment", plan.order, "batch_id", "start")


def pack(
    df: DataFrame,
    order: str,
    seq_len: int,
    batch_rows: int = 1024,
    columns: list[str] | None = None,
    shards: int = 1,
    max_segments: int = MAX_SEGMENTS,
) -> DataFrame:
    """``(batch_id, block_id, *columns)``; every list column is cut at the same places.

    ``shards`` reproduces batches taken inside that many contiguous worker shards. Lists are worked out twice: for
    their lengths, which say where every row begins in its batch, and for their elements, which move once.
    """
    columns = columns or ["input_ids"]
    plan = plan_segments(df, order, batch_rows, shards, max_segments, F.array_size(columns[0]))
    return _cut(plan.attach(df.select(order, *columns), _starts(plan)), plan, columns, seq_len)


def pack_text(
    df: DataFrame,
    text: str,
    order: str,
    seq_len: int,
    batch_rows: int = 1024,
    shards: int = 1,
    tokenizer=WORDS,
    mask: bool = False,
    max_segments: int = MAX_SEGMENTS,
    num_tokens: str | None = None,
) -> DataFrame:
    """Tokenize and pack. The raw text is what moves; tokens are made after the only
    exchange, since as lists they are several times larger than the text.

    Where each row begins is found from token counts. ``num_tokens`` names a column that has them, if there
    is one: then the text is read once. It has to agree with the tokenizer.
    """
    counts = F.col(num_tokens) if num_tokens else tokenizer.count(text)
    plan = plan_segments(df, order, batch_rows, shards, max_segments, counts)
    moved = plan.attach(df.select(order, text), _starts(plan))
    ids = moved.select("segment", "batch_id", "start", tokenizer.tokens(text).alias("input_ids"))
    columns = ["input_ids"]
    if mask:
        ids = ids.withColumn("attention_mask", F.array_repeat(F.lit(1), F.array_size("input_ids")))
        columns.append("attention_mask")
    return _cut(ids, plan, columns, seq_len)


def pack_report(
    df: DataFrame,
    order: str,
    seq_len: int,
    batch_rows: int = 1024,
    num_tokens: str = "num_tokens",
    shards: int = 1,
) -> DataFrame:
    """What packing keeps and drops, from token counts alone."""
    plan = plan_segments(df, order, batch_rows, shards, counts=F.col(num_tokens))
    batches = plan.places.groupBy("batch_id").agg(F.sum("n").alias("_t"))
    full = _div(F.col("_t"), seq_len)
    blocks = F.when(full > 0, full).otherwise((F.col("_t") > 0).cast("bigint"))
    kept = F.when(full > 0, full * seq_len).otherwise(F.col("_t"))
    zero = F.lit(0).cast("bigint")
    return batches.agg(
        F.coalesce(F.sum(blocks), zero).alias("blocks"),
        F.coalesce(F.sum(kept), zero).alias("kept_tokens"),
        F.coalesce(F.sum(F.col("_t") - kept), zero).alias("dropped_tokens"),
    )


def concat_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Ordered union: ``source`` and ``source_ord`` keep the order of the arguments."""
    tagged = [
        df.select(F.lit(name).alias("source"), F.lit(i).alias("source_ord"), "*")
        for i, (name, df) in enumerate(sources.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
