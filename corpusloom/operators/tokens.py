"""Tokenize, encode, decode, truncate and count."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.arrays import explode_elements
from corpusloom.functions.tokenizers import WORDS
from corpusloom.operators.ordering import check_keys
from corpusloom.operators.quality import take
from corpusloom.sources.store import stage

# A vocabulary within these measured bounds travels with the tasks.
IN_PLACE_ROWS = 262_144
IN_PLACE_CHARS = 16_000_000
# Of a larger one this part does: the 100,000 most frequent tokens, unless they are
# longer than 256 characters.
BROADCAST_ROWS = 100_000
BROADCAST_TOKEN_CHARS = 256


def tokenize(df: DataFrame, text: str, keep: list[str], tokenizer=WORDS) -> DataFrame:
    """``input_ids`` and an all-ones ``attention_mask``; other columns dropped."""
    return df.select(*keep, tokenizer.tokens(text).alias("input_ids")).withColumn(
        "attention_mask", F.array_repeat(F.lit(1), F.array_size("input_ids"))
    )


def tokenize_pair(
    df: DataFrame, first: str, second: str, keep: list[str], tokenizer=WORDS
) -> DataFrame:
    """The tokens of two columns as one sequence, first then second."""
    both = F.concat(tokenizer.tokens(first), tokenizer.tokens(second))
    return df.select(*keep, both.alias("input_ids")).withColumn(
        "attention_mask", F.array_repeat(F.lit(1), F.array_size("input_ids"))
    )


def truncate(df: DataFrame, n: int, column: str = "input_ids") -> DataFrame:
    """Keep the first n ids."""
    return df.withColumn(column, F.slice(column, 1, n))


def token_frequencies(df: DataFrame, column: str = "input_ids") -> DataFrame:
    """Occurrences of each token; counted before the shuffle, so hot tokens are cheap."""
    return (
        df.select(explode_elements(column, "_pos", "token"))
        .where(F.col("_pos").isNotNull())
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def vocab(df: DataFrame, column: str = "input_ids", max_size: int | None = None) -> DataFrame:
    """``(token, freq, token_id)``, ids by falling frequency, then token; the first
    ``max_size`` ids if given.

    Counted tokens are dealt out by ranges of that order, sorted inside them and written once, with their range and
    place in it; an id is the place plus the tokens of all ranges before. No task sorts every token.
    """
    in_order = [F.desc("freq"), F.asc("token")]
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranged = token_frequencies(df, column).repartitionByRange(*in_order).sortWithinPartitions(*in_order)
    found = stage(ranged.select("token", "freq", F.spark_partition_id().alias("_range"), place.alias("_place")), "vocab")
    # One row for each range, of which there are as many as shuffle partitions at most.
    sizes = found.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    ids = found.join(F.broadcast(before), "_range").select("token", "freq", (F.col("_before") + F.col("_place")).alias("token_id"))
    return ids if max_size is None else ids.where(F.col("token_id") < max_size)


def _in_head() -> Column:
    return (F.col("token_id") < BROADCAST_ROWS) & (F.length("token") <= BROADCAST_TOKEN_CHARS)


def _list_like() -> Callable[[pa.Array, pa.Array], pa.Array]:
    """Cuts elements into lists as another list array is cut. A function made here travels
    inside the task, so that Python workers need not have this package."""

    def like(lists: pa.Array, elements: pa.Array) -> pa.Array:
        offsets = pc.subtract(lists.offsets, lists.offsets[0])
        return pa.ListArray.from_arrays(offsets, elements, mask=lists.is_null())

    return like


def _look_up(
    table: DataFrame, key: str, value: str, report_misses: bool = False
) -> Callable[[Column], Column]:
    """A UDF that replaces list elements by their partners in a table of checked size; unknown
    ones become null. One hash lookup over the flattened batch.

    With ``report_misses`` it returns a struct of ``found`` and ``miss``, the places in
    the list that are unknown though not null.
    """
    value_type = table.schema[value].dataType.simpleString()
    rows = table.select(key, value).collect()
    element = pa.string() if value_type == "string" else pa.int64()
    keys, values = pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], element)
    like = _list_like()

    @F.arrow_udf(f"array<{value_type}>")
    def look_up(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        return like(lists, values.take(pc.index_in(flat, value_set=keys.cast(flat.type))))

    @F.arrow_udf(f"struct<found: array<{value_type}>, miss: array<int>>")
    def look_up_and_report(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        index = pc.index_in(flat, value_set=keys.cast(flat.type))
        missed = pc.and_(index.is_null(), flat.is_valid()).to_numpy(zero_copy_only=False)
        starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        places = np.arange(len(flat)) - np.repeat(starts[:-1], np.diff(starts))
        before = np.concatenate([[0], np.cumsum(missed)])
        miss = pa.ListArray.from_arrays(
            pa.array(before[starts], pa.int32()), pa.array(places[missed], pa.int32())
        )
        return pa.StructArray.from_arrays([like(lists, values.take(index)), miss], ["found", "miss"])

    return look_up_and_report if report_misses else look_up


def _fill_in(value_type: str) -> Callable[[Column, Column], Column]:
    """A UDF that writes ``(pos, value)`` pairs into lists, over the flattened batch."""
    like = _list_like()

    @F.arrow_udf(f"array<{value_type}>")
    def fill_in(lists: pa.Array, pairs: pa.Array) -> pa.Array:
        flat, flat_pairs = lists.flatten(), pairs.flatten()
        counts = pc.fill_null(pc.list_value_length(pairs), 0).to_numpy(zero_copy_only=False)
        starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        places = np.repeat(starts, counts) + pc.struct_field(flat_pairs, "pos").to_numpy()
        chosen = np.arange(len(flat))
        chosen[places] = len(flat) + np.arange(len(flat_pairs))
        both = pa.concat_arrays([flat, pc.struct_field(flat_pairs, "value").cast(flat.type)])
        return like(lists, both.take(pa.array(chosen)))

    return fill_in


def _translate_by_join(
    df: DataFrame, vocabulary: DataFrame, row_key: str, column: str, key: str, value: str
) -> DataFrame:
    """Look elements up in a vocabulary of any size.

    The most frequent tokens, a table of bounded size, are looked up inside the row, once: found ids, and
    the places and tokens not found, are written. The latter, single rare tokens, are joined with the rest of the
    vocabulary and filled in by row.
    """
    head, tail = vocabulary.where(_in_head()), vocabulary.where(~_in_head())
    looked_up = _look_up(head, key, value, report_misses=True)(column)
    missed = F.transform("_l.miss", lambda pos: F.struct(pos.alias("pos"), F.get(column, pos).alias("key")))
    rows = df.select(row_key, column, looked_up.alias("_l")).select(
        row_key, F.col("_l.found").alias("_found"), missed.alias("_missed")
    )
    rows = stage(rows, "looked-up")
    check_keys(rows.select(row_key), row_key)
    pairs = (
        rows.select(row_key, F.explode("_missed").alias("_m"))
        .join(tail.select(F.col(key).alias("_tail_key"), F.col(value).alias("value")), F.col("_m.key") == F.col("_tail_key"))
        .groupBy(row_key)
        .agg(F.collect_list(F.struct("_m.pos", "value")).alias("_pairs"))
    )
    fill_in = _fill_in(vocabulary.schema[value].dataType.simpleString())
    return rows.select(row_key, "_found").join(pairs, row_key, "left").select(
        row_key, fill_in("_found", "_pairs").alias(column)
    )


def _translate(
    df: DataFrame,
    vocabulary: DataFrame,
    row_key: str,
    column: str,
    key: str,
    value: str,
    in_place_rows: int,
) -> DataFrame:
    """Replace each element of ``column`` by its vocabulary partner; unknown ones are null.

    A vocabulary whose measured size is within the bounds travels with the tasks and
    nothing is shuffled. A larger one is joined. Null and repeated row keys are refused either way.
    """
    size = vocabulary.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("token")).alias("chars")
    ).first()
    if size["rows"] > in_place_rows or (size["chars"] or 0) > IN_PLACE_CHARS:
        return _translate_by_join(df, vocabulary, row_key, column, key, value)
    check_keys(df.select(row_key), row_key)
    return df.select(row_key, _look_up(vocabulary, key, value)(column).alias(column))


def encode_ids(
    df: DataFrame,
    vocabulary: DataFrame,
    row_key: str,
    column: str = "input_ids",
    in_place_rows: int = IN_PLACE_ROWS,
) -> DataFrame:
    """Token strings to vocabulary ids, in order; tokens outside it become null.

    A vocabulary of more than ``in_place_rows`` tokens is joined instead of sent to the tasks; the
    result is the same.
    """
    return _translate(df, vocabulary, row_key, column, "token", "token_id", in_place_rows)


def decode_ids(
    df: DataFrame,
    vocabulary: DataFrame,
    row_key: str,
    column: str = "input_ids",
    special_ids: list[int] | None = None,
    separator: str = " ",
) -> DataFrame:
    """Ids back to ``text``. ``special_ids`` are left out, as in ``skip_special_tokens``."""
    if special_ids:
        df = df.withColumn(column, F.filter(column, lambda i: ~i.isin(special_ids)))
    words = _translate(df, vocabulary, row_key, column, "token_id", "token", IN_PLACE_ROWS)
    return words.select(row_key, F.array_join(column, separator).alias("text"))


def query_rows(
    df: DataFrame, prompt: str, n: int, keep: list[str], tokenizer=WORDS, separator: str = " "
) -> DataFrame:
    """Prompt, its first n tokens, and the text those tokens stand for.

    Word tokens are their own text; for vocabulary ids apply :func:`decode_ids` to
    the truncated ``input_ids``.
    """
    ids = tokenize(df, prompt, [*keep, prompt], tokenizer).drop("attention_mask")
    ids = truncate(ids, n)
    if tokenizer.element_type != "string":
        return ids
    return ids.withColumn("query", F.array_join("input_ids", separator))


def _count(tokenizer, column: str, second: str | None) -> Column:
    count = tokenizer.count(column)
    return count if second is None else count + tokenizer.count(second)


def token_count(
    df: DataFrame, column: str, keep: list[str], second: str | None = None, tokenizer=WORDS
) -> DataFrame:
    """Per-row ``num_tokens``; with ``second``, of the pair."""
    return df.select(*keep, _count(tokenizer, column, second).alias("num_tokens"))


def _total(column: Column) -> Column:
    # An empty table counts 0 tokens, where sum alone gives null.
    return F.coalesce(F.sum(column.cast("bigint")), F.lit(0).cast("bigint"))


def total_tokens(
    df: DataFrame, column: str, second: str | None = None, tokenizer=WORDS
) -> DataFrame:
    """One row ``total_tokens``; summed inside each task before the exchange."""
    return df.agg(_total(_count(tokenizer, column, second)).alias("total_tokens"))


def token_report(totals: DataFrame, column: str = "total_tokens") -> DataFrame:
    """Printable sizes: billions (10^9, three decimals) and units of 1024^3."""
    return totals.select(
        "*",
        F.format_string("%.3fB", F.col(column) / F.lit(1e9)).alias("billions"),
        F.format_string("%.6fb", F.col(column) / F.lit(float(1024**3))).alias("binary_billions"),
    )


def estimate_total(
    df: DataFrame, column: str, order: str, sample_rows: int = 100_000, tokenizer=WORDS
) -> DataFrame:
    """Average tokens of the first ``sample_rows`` rows times the number of rows."""
    sample = take(df, sample_rows, order).agg(
        F.avg(tokenizer.count(column)).alias("avg_tokens"),
        F.count(F.lit(1)).alias("sampled_rows"),
    )
    size = df.agg(F.count(F.lit(1)).alias("total_rows"))
    # Two one-row tables become one row.
    both = sample.unionByName(size, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("sampled_rows", "total_rows", "avg_tokens")]
    )
    return both.withColumn("estimated_tokens", F.col("avg_tokens") * F.col("total_rows"))


def estimate_sources(
    df: DataFrame, column: str, by: list[str], key: str, sample_rows: int = 1000, tokenizer=WORDS
) -> DataFrame:
    """Estimated tokens of each source from a sample of its rows, with an error: ``(*by, num_rows, sampled_rows,
    avg_tokens, estimated_tokens, std_error, low, high)``.

    The sample is the ``sample_rows`` rows whose ``key`` has the smallest hash, ties to the smaller key: a bottom-k sample.
    Every task keeps its own k smallest of each source, and of these the k smallest are the source's,
    so the same rows are chosen however the table is cut, and only they are tokenized. ``low`` and ``high``
    lie 1.96 standard errors off, for a sample drawn without replacement; a source that is
    sampled whole has no error. Keys that repeat, or are null, sample their rows together.
    """
    hashed = F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("")), 256)
    lowest = W.partitionBy(*by).orderBy("_h", F.col(key).asc_nulls_first(), F.col(column).asc_nulls_first())
    sampled = (
        df.select(*by, key, column, hashed.alias("_h"))
        .withColumn("_place", F.row_number().over(lowest))
        .where(F.col("_place") <= sample_rows)
        .select(*by, F.coalesce(tokenizer.count(column), F.lit(0)).cast("double").alias("_n"))
    )
    found = sampled.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sampled_rows"), F.avg("_n").alias("avg_tokens"), F.coalesce(F.var_samp("_n"), F.lit(0.0)).alias("_v")
    )
    sizes = df.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(F.count(F.lit(1)).alias("num_rows"))
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    n, m = F.col("num_rows"), F.col("sampled_rows")
    error = n * F.sqrt(F.col("_v") / m * (F.lit(1.0) - m / n))
    total = F.col("avg_tokens") * n
    return (
        found.join(sizes, same)
        .withColumn("estimated_tokens", total)
        .withColumn("std_error", error)
        .select(
            *by, "num_rows", "sampled_rows", "avg_tokens", "estimated_tokens", "std_error",
            (F.col("estimated_tokens") - 1.96 * F.col("std_error")).alias("low"),
            (F.col("estimated_tokens") + 1.96 * F.col("std_error")).alias("high"),
        )
    )


def source_report(df: DataFrame, column: str, by: list[str], tokenizer=WORDS) -> DataFrame:
    """Rows and tokens per source."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_rows"), _total(tokenizer.count(column)).alias("total_tokens")
    )


def source_rollup(df: DataFrame, column: str, by: list[str], tokenizer=WORDS) -> DataFrame:
    """The same with subtotals; rolled-up columns read ``(all)``.

    Aggregated to one row per combination first, so the rollup expands a small table.
    """
    base = source_report(df, column, by, tokenizer)
    named = [F.when(F.grouping(c) == 1, "(all)").otherwise(F.col(c)).alias(f"_{c}") for c in by]
    rolled = base.rollup(*by).agg(
        *named, F.sum("num_rows").alias("num_rows"), F.sum("total_tokens").alias("total_tokens")
    )
    return rolled.select(*[F.col(f"_{c}").alias(c) for c in by], "num_rows", "total_tokens")
