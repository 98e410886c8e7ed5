"""Packing of streamed sources: blocks as they fill, the unfinished rest kept as state.

A source's state is what packing has to remember between micro-batches: which batch is open, how
many rows it has, which block comes next, and the tokens (fewer than ``seq_len``) that fill no block yet. It
lives in Spark's state store, so a query that is stopped between triggers, or fails inside one, goes on from its
checkpoint with nothing lost and nothing twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _field(schema: T.StructType, name: str) -> T.StructField:
    return T.StructField(name, schema[name].dataType)


def pack_stream(
    stream: DataFrame,
    by: list[str],
    order: str,
    seq_len: int,
    batch_rows: int = 1024,
    columns: list[str] | None = None,
) -> DataFrame:
    """``(*by, batch_id, block_id, *columns)``: the blocks that :func:`~corpusloom.operators.packing.pack` makes of each
    source with one shard, as soon as they are full or their batch is.

    ``by`` names the columns that tell sources apart (null is one of its own). A source is one sequence, so it is
    packed by one task per micro-batch; of a large one, make a column of its shards part of ``by``.
    A micro-batch's rows of a source are sorted by ``order`` in that task: the trigger's limit on files or bytes is the
    bound of its memory. Keys have to rise from one micro-batch to the next, and null, repeated or late
    keys are refused, as all that goes by position does. Null lists are empty.

    What the last, unfinished batch of a source would give as its one short block is not in the stream, since
    further rows may come: :func:`open_blocks` reads it from the state.
    """
    columns = columns or ["input_ids"]
    schema = stream.schema
    lists = [_field(schema, c) for c in columns]
    numbers = [T.StructField(c, T.LongType()) for c in ("batch_id", "block_id")]
    result = T.StructType([*(_field(schema, c) for c in by), *numbers, *lists])
    kept = T.StructType(
        [T.StructField("batch_id", T.LongType()), T.StructField("batch_row", T.LongType()), T.StructField("block_id", T.LongType()),
         T.StructField("last_key", schema[order].dataType), *lists]
    )

    # Workers get these functions by value: they need no package.
    def joined(tail, lists: pd.Series) -> np.ndarray:
        parts = [np.asarray(x) for x in (tail, *lists) if x is not None and len(x)]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=object)

    def as_rows(key: tuple, batch: int, numbers: list[int], blocks: list[list]) -> pd.DataFrame:
        told = {name: [value] * len(numbers) for name, value in zip(by, key)}
        return pd.DataFrame({**told, "batch_id": [batch] * len(numbers), "block_id": numbers, **dict(zip(columns, blocks))})

    def advance(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(chunks), ignore_index=True)
        if rows[order].isna().any():
            raise ValueError(f"order key {order} is null in source {key}")
        rows = rows.sort_values(order, kind="stable", ignore_index=True)
        batch, row, block, last, *tails = state.get if state.exists else (0, 0, 0, None, *([] for _ in columns))
        keys = rows[order]
        if keys.duplicated().any() or (last is not None and keys.iloc[0] <= last):
            raise ValueError(f"order key {order} of source {key} is not above all before it, for example {keys.iloc[0]!r}")
        at = 0
        while at < len(rows):
            stop = min(len(rows), at + batch_rows - row)
            flat = [joined(tail, rows[c].iloc[at:stop]) for tail, c in zip(tails, columns)]
            row += stop - at
            at = stop
            full = len(flat[0]) // seq_len
            blocks = [[f[i * seq_len : (i + 1) * seq_len] for i in range(full)] for f in flat]
            tails = [f[full * seq_len :] for f in flat]
            numbers = list(range(block, block + full))
            block += full
            if row == batch_rows:
                if block == 0 and len(tails[0]):
                    # A batch shorter than a block is one short block; a longer one drops its rest.
                    blocks, numbers = [[t] for t in tails], [0]
                yield as_rows(key, batch, numbers, blocks)
                batch, row, block, tails = batch + 1, 0, 0, [f[:0] for f in flat]
            else:
                yield as_rows(key, batch, numbers, blocks)
        # A native value: the state takes no numpy types.
        last = keys.iloc[-1]
        state.update((batch, row, block, last.item() if hasattr(last, "item") else last, *(t.tolist() for t in tails)))

    wanted = stream.select(*by, order, *columns)
    return wanted.groupBy(*by).applyInPandasWithState(advance, result, kept, "append", GroupStateTimeout.NoTimeout)


def open_blocks(spark: SparkSession, checkpoint: str, seq_len: int, columns: list[str] | None = None) -> DataFrame:
    """The short block of each source whose last batch is unfinished and has not filled one block, with the columns of
    :func:`pack_stream`, from the state that the last finished micro-batch left in ``checkpoint``.

    Together with the stream's blocks these are all blocks of the rows so far. Append them once no more rows come.
    """
    columns = columns or ["input_ids"]
    state = spark.read.format("statestore").load(checkpoint)
    left = "value.groupState" if "groupState" in state.schema["value"].dataType.names else "value"
    short = state.select("key.*", f"{left}.*").where(
        (F.col("block_id") == 0) & (F.array_size(columns[0]) > 0) & (F.array_size(columns[0]) < seq_len)
    )
    return short.drop("batch_row", "last_key")
