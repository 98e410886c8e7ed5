"""What the order of filters costs, from one count for each set of failed filters (operator 13).

1. One scan gives each row its failed text filters as bits, and two hashes of its text.
2. A counting Bloom sketch says which texts are unique for certain: each text adds one to ``HASHES``
   counters, and a counter that ends at one has met one text. Counters are added up in tasks and merged by
   the shuffle; only a bit for each counter above one reaches the driver.
3. Texts that may repeat are grouped in full for their smallest key. A row with a larger key repeats.
4. Rows are counted by part and set of failed filters. Every order of the filters, and what each of
   its steps removes, is a sum of such counts.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let
from corpusloom.llm.shipping import ship
from corpusloom.sources.store import stage

WORD = "[^\\x20\\x09-\\x0D]+"
FILTERS = "ABCDE"
REPEAT = FILTERS.index("E")
HASHES = 2
#: Counters for each row, and the most of them: one bit each is broadcast, 32 MB at most.
COUNTERS_PER_ROW, MAX_COUNTER_BITS, MIN_COUNTER_BITS = 16, 28, 16


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: the text fails filters A to D. It has under 200 words, under half of its words are
    distinct, over 3 % of its code points are capitals, it holds one of ``#$%&*|``."""
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    counted = let(
        F.regexp_extract_all(text, F.lit(f"({WORD})")),
        lambda w: F.struct(F.size(w).cast("bigint").alias("n"), F.size(F.array_distinct(w)).cast("bigint").alias("distinct")),
    )
    by_words = let(
        counted,
        lambda c: F.when(c["n"] < 200, 1).otherwise(0) + F.when(c["distinct"] * 100 < c["n"] * 50, 2).otherwise(0),
    )
    by_signs = F.when(capitals.cast("bigint") * 100 > F.length(text).cast("bigint") * 3, 4).otherwise(0)
    return by_words + by_signs + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)


def counter_bits(rows: int) -> int:
    """Counters of the sketch as a power of two: ``COUNTERS_PER_ROW`` a row between fixed bounds."""
    return min(MAX_COUNTER_BITS, max(MIN_COUNTER_BITS, (max(rows, 1) * COUNTERS_PER_ROW - 1).bit_length()))


def _counters(h1: Column, h2: Column, bits: int) -> list[Column]:
    return [F.call_function("shiftrightunsigned", h, F.lit(64 - bits)) for h in (h1, h2)]


def possible_repeats(texts: DataFrame, h1: str, h2: str, bits: int):
    """A function from two hash columns to whether their text may be in ``texts`` more than once.

    It never says no of a text that is there twice. With more texts than counters it says yes ever more often,
    which costs time behind it and changes no result.
    """
    ship(texts)
    added = texts.select(F.explode(F.array(*_counters(F.col(h1), F.col(h2), bits))).alias("counter"))
    above_one = added.groupBy("counter").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    words = above_one.groupBy(F.shiftright("counter", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("counter") % 64).cast("int"))).alias("set")
    )
    # One row for each 64 counters at most.
    table = words.toArrow()
    filled = np.zeros((1 << bits) // 64, dtype=np.uint64)
    filled[table["word"].to_numpy()] = table["set"].to_numpy().view(np.uint64)
    shared = texts.sparkSession.sparkContext.broadcast(filled)

    @F.pandas_udf("boolean")
    def repeated(first, second):
        import pandas as pd

        known = shared.value
        hit = np.ones(len(first), dtype=bool)
        for h in (first, second):
            place = h.to_numpy().astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)
            hit &= ((known[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
        return pd.Series(hit)

    return repeated


def failed_filters(df: DataFrame, key: str, text: str, part: Column) -> DataFrame:
    """(key, part, failed): the bits of the failed filters of every row, A to D by its text, E if the text is
    identical to that of a row with a smaller key.

    A null text is empty. A row without a key repeats nothing and hides nothing; rows that share key and text
    do not repeat each other. Other columns of ``df`` are not read.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    hashes = [F.xxhash64(body).alias("h1"), F.xxhash64(F.lit("second"), body).alias("h2")]
    source = df.select(F.col(f"`{key}`").alias("key"), part.alias("part"), body.alias("text"), *hashes)
    rows = stage(source.select("key", "part", text_failures(F.col("text")).alias("failed"), "h1", "h2"), "failed")
    repeated = possible_repeats(rows, "h1", "h2", counter_bits(rows.count()))
    may = F.col("key").isNotNull() & repeated("h1", "h2")
    first = (
        source.select("key", "text", "h1", "h2").where(may)
        .groupBy("text")
        .agg(F.min("key").alias("least"), F.max("key").alias("most"), F.first("h1").alias("g1"), F.first("h2").alias("g2"))
        .where("most > least")
        .select("g1", "g2", "least")
    )
    first = stage(first, "first-of-text")
    marked = rows.withColumn("may", F.coalesce(may, F.lit(False)))
    later = F.when(F.col("key") > F.col("least"), 1 << REPEAT).otherwise(0)
    judged = marked.where("may").join(first, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")), "left")
    return (
        judged.select("key", "part", (F.col("failed") + later).alias("failed"))
        .unionByName(marked.where("not may").select("key", "part", "failed"))
    )


def failure_counts(failed: DataFrame, labels: DataFrame, key: str, good: Column, toxic: Column) -> DataFrame:
    """(part, failed, n, n_good, n_toxic): rows of :func:`failed_filters` by part and failed filters.

    A row is good (toxic) if any label row of its key is. Rows without a key have no labels; null labels say
    nothing. Equal (key, part, failed) are counted before they meet the labels, so a key of many rows is few.
    """
    said = (
        labels.select(F.col(f"`{key}`").alias("l_key"), good.cast("int").alias("good"), toxic.cast("int").alias("toxic"))
        .where("l_key is not null")
        .groupBy("l_key")
        .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    )
    rows = failed.groupBy("key", "part", "failed").agg(F.count(F.lit(1)).alias("n"))
    joined = rows.join(said, F.col("key") == F.col("l_key"), "left")
    return joined.groupBy("part", "failed").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("n_good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("n_toxic"),
    )


def filter_orders(counts: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """One row for each part, order of the filters and step, from :func:`failure_counts`.

    ``kept``, ``removed``, ``redundant`` (failed, but gone before), ``unique_fails`` (failing this filter
    only), ``good_lost``, ``toxic_lost`` and ``shapley``, which is what the filter removes, summed over all
    orders: a set of m failed filters gives each of them n! / m of its rows. A part has one row of at
    most 2^n counts, whatever its size, and n! times n rows of results.
    """
    names = FILTERS[:n_filters]
    steps = [
        ("".join(names[f] for f in order), i + 1, sum(1 << f for f in order[:i]), 1 << f)
        for order in permutations(range(n_filters))
        for i, f in enumerate(order)
    ]
    orders = len(steps) // n_filters
    plan = "array<struct<filter_order:string,step:int,before:int,own:int>>"
    table = F.from_json(
        F.lit("[" + ",".join(f'{{"filter_order":"{o}","step":{s},"before":{b},"own":{w}}}' for o, s, b, w in steps) + "]"), plan
    )
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "n_good", "n_toxic")).alias("sets"))
    each = by_part.withColumn("s", F.explode(table)).select("part", "sets", "s.*")

    def total(column: str, condition) -> Column:
        return F.aggregate(
            "sets", F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(condition(x["failed"]), x[column]).otherwise(0)
        )

    before, own = F.col("before"), F.col("own")

    def goes(m: Column) -> Column:
        return (m.bitwiseAND(before) == 0) & (m.bitwiseAND(own) != 0)

    share = F.array(*[F.lit(orders // m).cast("bigint") for m in range(1, n_filters + 1)])
    shares = F.aggregate(
        "sets",
        F.lit(0).cast("bigint"),
        lambda acc, x: acc
        + F.when(x["failed"].bitwiseAND(own) != 0, x["n"] * F.element_at(share, F.bit_count(x["failed"]).cast("int"))).otherwise(0),
    )
    return each.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: m.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total("n", goes).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(before) != 0) & (m.bitwiseAND(own) != 0)).alias("redundant"),
        total("n", lambda m: m == own).alias("unique_fails"),
        total("n_good", goes).alias("good_lost"),
        total("n_toxic", goes).alias("toxic_lost"),
        shares.alias("shapley"),
    )


def audit_filters(
    df: DataFrame, labels: DataFrame, key: str, text: str, part: Column, good: Column, toxic: Column
) -> DataFrame:
    """:func:`filter_orders` of ``df``, labelled by ``labels``. Empty tables give no rows; null and
    repeated keys, null texts and labels are as in :func:`failed_filters` and :func:`failure_counts`."""
    failed = failed_filters(df, key, text, part)
    counts = stage(failure_counts(failed, labels, key, good, toxic), "failure-counts")
    return filter_orders(counts)

