"""Training labels and sequence columns on id arrays; only ``sequence_offsets`` shuffles.

``IGNORE`` marks positions without loss. On string tokens it is the text ``-100``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.arrays import explode_elements, let
from corpusloom.operators.ordering import Segments, plan_segments

IGNORE = -100


def _element(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType.elementType


def _value(df: DataFrame, column: str, value) -> Column:
    return F.lit(value).cast(_element(df, column))


def pad_batch(
    df: DataFrame, length: int | Column, pad, column: str = "input_ids", mask: str = "attention_mask"
) -> DataFrame:
    """Pad on the right to ``length`` and mark real tokens 1, padding 0.

    Longer rows stay as they are; :func:`~corpusloom.operators.tokens.truncate` first.
    """
    n = F.array_size(column)
    fill = F.greatest((length if isinstance(length, Column) else F.lit(length)) - n, F.lit(0))
    return df.withColumn(
        mask, F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), fill))
    ).withColumn(column, F.concat(column, F.array_repeat(_value(df, column, pad), fill)))


def pad_longest(
    df: DataFrame,
    pad,
    order: str,
    batch_rows: int,
    column: str = "input_ids",
    mask: str = "attention_mask",
    **options,
) -> DataFrame:
    """Pad each batch of ``batch_rows`` rows in ``order`` to its longest row.

    Adds ``batch_id``, ``batch_row`` and the mask. Null rows stay null and count as empty.
    ``options`` are those of :func:`~corpusloom.operators.ordering.plan_segments`.
    """
    plan = plan_segments(df, order, batch_rows, counts=F.array_size(column), **options)
    places = batch_maximum(plan, "_width").drop("n", "start")
    return pad_batch(plan.attach(df, places), F.col("_width").cast("int"), pad, column, mask).drop("_width", "segment")


def causal_labels(df: DataFrame, pad, column: str = "input_ids") -> DataFrame:
    """Labels are the ids, padding ignored."""
    pad, ignore = _value(df, column, pad), _value(df, column, IGNORE)
    return df.withColumn(
        "labels", F.transform(column, lambda x: F.when(x == pad, ignore).otherwise(x))
    )


def _marker_starts(ids: Column, marker: list[Column]) -> Column:
    """0-based places where ``marker`` begins, in order."""

    def starts_here(x, i):
        match = x == marker[0]
        for offset, expected in enumerate(marker[1:], 1):
            match = match & (F.get(ids, i + offset) == expected)
        return F.when(match, i).otherwise(F.lit(-1))

    return F.filter(F.transform(ids, starts_here), lambda p: p >= 0)


def completion_labels(
    df: DataFrame, instruction: list, response: list, column: str = "input_ids"
) -> DataFrame:
    """Labels only on assistant spans, found by their marker tokens.

    ``h`` are starts of instruction markers and ``r`` ends of response markers. All is
    ignored if either is missing. If the first response ends after the first instruction
    begins, as usual, the text up to it is ignored, then each span from an
    instruction to the end of its response marker; an unanswered last instruction is
    ignored to the end. A text that opens with a response counts as having an
    instruction at 0. The time is linear in tokens and markers together.
    """
    element = _element(df, column)
    ignore = F.lit(IGNORE).cast(element)
    first = F.lit(0)

    def markers(ids):
        starts = _marker_starts(ids, [F.lit(v).cast(element) for v in instruction])
        answers = _marker_starts(ids, [F.lit(v).cast(element) for v in response])
        ends = F.transform(answers, lambda p: p + len(response))
        return F.struct(starts.alias("h"), ends.alias("r"))

    def opened(found):
        starts_with_answer = F.get(found["h"], first) > F.get(found["r"], first)
        h = F.when(starts_with_answer, F.concat(F.array(first), found["h"])).otherwise(found["h"])
        return F.struct(h.alias("h"), found["r"].alias("r"))

    def borders(found):
        h, r = found["h"], found["r"]
        pairs = F.zip_with(h, r, lambda a, b: F.struct(a.alias("h"), b.alias("r")))
        # Both run upwards, so what a span hides begins at its start or where the one before ends.
        return F.struct(
            ((F.array_size(h) == 0) | (F.array_size(r) == 0)).alias("none"),
            F.get(r, first).alias("start"),
            F.filter(pairs, lambda p: p["h"] < p["r"]).alias("spans"),
            F.when(F.array_size(h) > F.array_size(r), F.get(h, F.array_size(h) - 1)).alias("open"),
        )

    def swept(ids, b):
        """The labels in one walk from border to border: what is seen, then what is hidden, of each span."""
        n = F.array_size(ids)

        def seen(start, end):
            return F.slice(ids, start + 1, F.greatest(end - start, first))

        def hidden(start, end):
            return F.array_repeat(ignore, F.greatest(end - start, first))

        def walk(ends):
            pieces = F.zip_with(
                ends, b["spans"], lambda e, p: F.concat(seen(e, p["h"]), hidden(F.greatest(p["h"], e), p["r"]))
            )
            last = F.get(ends, F.array_size(ends) - 1)
            rest = F.greatest(F.coalesce(b["open"], n), last)
            return F.concat(
                hidden(first, b["start"]), F.flatten(F.slice(pieces, first + 1, F.array_size(b["spans"]))),
                seen(last, rest), hidden(rest, n),
            )

        ends = F.concat(F.array(b["start"]), F.transform(b["spans"], lambda p: p["r"]))
        return F.when(b["none"], F.array_repeat(ignore, n)).otherwise(let(ends, walk))

    def labels(ids):
        return let(let(let(markers(ids), opened), borders), lambda b: swept(ids, b))

    # A computed array is sliced in place; a stored one would be copied whole for each slice.
    return df.withColumn("labels", let(F.transform(column, lambda x: x), labels))


def next_token_pairs(
    df: DataFrame, keep: list[str], column: str = "input_ids", labels: str = "labels"
) -> DataFrame:
    """One row per supervised prediction: the token at ``pos`` and the next label."""
    n = F.array_size(column)
    rest = F.greatest(n - 1, F.lit(0))
    pairs = F.arrays_zip(
        F.slice(column, F.lit(1), rest).alias("token"),
        F.slice(labels, F.lit(2), rest).alias("label"),
    )
    ignore = F.lit(IGNORE).cast(_element(df, labels))
    return (
        df.select(*keep, explode_elements(pairs, "pos", "_pair"))
        .select(*keep, "pos", F.col("_pair.token").alias("token"), F.col("_pair.label").alias("label"))
        .where(F.col("pos").isNotNull() & (F.col("label") != ignore))
    )


def supervised_token_count(df: DataFrame, keep: list[str], labels: str = "labels") -> DataFrame:
    """Labels that carry loss after the shift by one."""
    ignore = F.lit(IGNORE).cast(_element(df, labels))
    shifted = F.slice(labels, F.lit(2), F.greatest(F.array_size(labels) - 1, F.lit(0)))
    return df.select(
        *keep, F.array_size(F.filter(shifted, lambda x: x != ignore)).alias("supervised_tokens")
    )


def position_ids(df: DataFrame, mask: str = "attention_mask") -> DataFrame:
    """Running count of real tokens minus one; padded places get 1.

    A running sum over an array has no built-in form that is linear in its length, so it
    is one cumulative sum per Arrow batch.
    """

    @F.arrow_udf("array<int>")
    def places(masks: pa.Array) -> pa.Array:
        flat = pc.fill_null(masks.flatten(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = masks.offsets.to_numpy() - masks.offsets[0].as_py()
        total = np.cumsum(flat)
        before = np.concatenate([[0], total])[starts[:-1]]
        found = np.where(flat == 0, 1, total - np.repeat(before, np.diff(starts)) - 1)
        return pa.ListArray.from_arrays(
            pa.array(starts, pa.int32()), pa.array(found, pa.int32()), mask=masks.is_null()
        )

    return df.withColumn("position_ids", places(F.col(mask).cast("array<int>")))


def sequence_offsets(df: DataFrame, order: str, batch_rows: int, mask: str = "attention_mask") -> DataFrame:
    """Unpadded layout of each batch of rows.

    Per row its length, the offsets before and after it in the unpadded stream, the
    longest length of the batch, and the places of its real tokens in the flattened
    (row x width) batch. Lengths and offsets are found from counts alone; the mask moves once, and
    the places are made behind that exchange.
    """
    plan = plan_segments(df, order, batch_rows, counts=F.array_size(F.filter(mask, lambda x: x != 0)))
    real = F.filter(
        F.sequence(F.lit(0), F.array_size(mask) - 1), lambda i: F.get(F.col(mask), i) != 0
    )
    real = F.when(F.array_size(mask) > 0, real).otherwise(F.array().cast("array<int>"))
    width = F.array_size(mask).cast("bigint")
    return plan.attach(df.select(order, mask), batch_maximum(plan, "max_seqlen")).select(
        order,
        "batch_id",
        "batch_row",
        F.col("n").alias("seqlen"),
        F.col("start").alias("start_offset"),
        (F.col("start") + F.col("n")).alias("end_offset"),
        "max_seqlen",
        F.transform(real, lambda i: F.col("batch_row") * width + i.cast("bigint")).alias("flat_indices"),
    )


def batch_maximum(plan: Segments, name: str) -> DataFrame:
    """The places of ``plan`` with the largest count of their batch."""
    if plan.split:
        return plan.places.join(plan.places.groupBy("batch_id").agg(F.max("n").alias(name)), "batch_id")
    whole = W.partitionBy(*plan.batch_keys)
    return plan.places.repartition("segment").withColumn(name, F.max("n").over(whole))


def last_valid_index(df: DataFrame, pad, column: str = "input_ids") -> DataFrame:
    """Index of the token before the first padding; the last index if there is none,
    or if the row starts with padding (the index wraps round)."""
    first_pad = F.array_position(column, _value(df, column, pad))
    n = F.array_size(column)
    # array_position counts from 1 and gives 0 for "absent".
    before = F.when(first_pad == 0, F.lit(-1)).otherwise(first_pad.cast("int") - 2)
    return df.withColumn("last_index", F.when(n > 0, F.pmod(before, n)))
