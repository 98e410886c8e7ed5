"""Mixing sources to target weights by hash-threshold histograms (operator 10).

Every row has a hash. A source whose target is ``f`` times its size and a rest takes each row
``f`` times, and the rows whose hash is below the source's threshold once more. The threshold
is found without sorting rows: sizes are summed by source and hash bucket, a running sum over
the buckets (4,096 of a source) names the bucket in which the rest is used up, and only that
bucket's rows are summed again by the next digits of the hash, until it holds a single hash.
Thresholds of a larger target contain those of a smaller one.

Only DataFrame operations; sums are combined before the shuffle, so a source may hold any share of
the rows. The tables of sums and thresholds have a row per source (and bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.sources.store import drop_staged, stage

HASH_BITS, BUCKET_BITS = 60, 12
WORD = "[^ \\t-\\r]++"


def word_count(text: str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def row_hash(*columns: str) -> Column:
    """60 bits that depend on the values alone, so that reruns agree; equal rows are taken alike."""
    parts = [F.coalesce(F.md5(F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size, target): sources by code point, null last, weigh ``weights`` in turn.

    The targets share the sum of all sizes by weight, but none exceeds ``cap`` times its
    source's size; what is above is shared again by weight until none is. That ends at one level
    ``x`` with target = min(cap * size, x * weight), which is found by adding sources up in the order in
    which a rising level reaches their caps: a window over one row per source.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), turn.cast("int")).cast("bigint")
    full = (F.col("source_size") * cap).alias("full")
    named = sizes.select("source", "source_size", weight.alias("weight"), full)
    by_cap = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0))
    among = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (left / among).alias("level")
    open_ = named.select("*", level).withColumn(
        "fits", F.col("level") * F.col("weight") <= F.col("full")
    )
    # In the order of ``by_cap``: a struct's nulls would come first.
    place = F.struct((F.col("full") / F.col("weight")).alias("a"), F.col("source").isNull().alias("none"), "source", "level")
    final = F.min(F.when(F.col("fits"), place)).over(everything)
    target = F.least(F.col("full").cast("double"), F.coalesce(final["level"], F.lit(0.0)) * F.col("weight"))
    return open_.select("source", "source_size", target.alias("target"))


def mixture_plan(
    rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3
) -> DataFrame:
    """(source, source_size, target, times, cut): take each row ``times``, and once more below ``cut``.

    ``rows`` has ``source``, ``size`` (not negative) and ``h`` of :func:`row_hash`; pass a scan or a
    written table, it is read once per level of refinement. A level is needed for every 4,096-fold
    of rows in a bucket, at most five.
    """
    targets = source_targets(rows, weights, cap)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("times", times.cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("times") * F.col("source_size")
    )
    plan = stage(plan.withColumn("prefix", F.lit(0).cast("bigint")).withColumn("used", F.lit(0).cast("bigint")), "targets")
    filled = rows.where("size > 0").select("source", "size", "h")
    shift = HASH_BITS
    many = True
    while many and shift > 0:
        above, shift = shift, shift - BUCKET_BITS
        bucket = F.shiftright("h", shift).alias("bucket")
        known = plan.select(F.col("source").alias("p_source"), "prefix", "used", "rest")
        inside = filled.join(
            known, F.col("source").eqNullSafe(F.col("p_source")) & (F.shiftright("h", above) == F.col("prefix"))
        )
        sums = inside.groupBy("source", bucket).agg(
            F.sum("size").alias("inside"),
            F.min("h").alias("low"),
            F.max("h").alias("high"),
            F.first("used").alias("used"),
            F.first("rest").alias("rest"),
        )
        running = F.sum("inside").over(W.partitionBy("source").orderBy("bucket"))
        boundary = (
            sums.withColumn("upto", F.col("used") + running)
            .where(F.col("upto") > F.col("rest"))
            .groupBy(F.col("source").alias("b_source"))
            .agg(F.min(F.struct("bucket", "upto", "inside", "low", "high")).alias("b"))
        )
        plan = stage(
            plan.join(boundary, F.col("source").eqNullSafe(F.col("b_source")), "left").select(
                "source", "source_size", "target", "times", "rest",
                F.coalesce("b.bucket", F.lit(1 << HASH_BITS)).alias("prefix"),
                (F.col("b.upto") - F.col("b.inside")).alias("used"),
                "b.inside", "b.low", "b.high",
            ),
            "thresholds",
        )
        many = plan.agg(F.max(F.col("low") < F.col("high"))).first()[0] or False
    # The one hash left is taken if that ends nearer to the rest.
    nearer = F.col("rest") * 2 > F.col("used") * 2 + F.col("inside")
    cut = F.coalesce(F.col("low") + nearer.cast("bigint"), F.lit(0))
    return plan.select("source", "source_size", "target", "times", cut.cast("bigint").alias("cut"))


def apply_mixture(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``taken``, the size times the number of copies.

    The plan is a written table, so Spark knows its size and broadcasts it only if it is small.
    """
    known = plan.withColumnRenamed("source", "p_source")
    copies = F.col("times") + (F.col("h") < F.col("cut")).cast("bigint")
    return (
        rows.join(known, F.col("source").eqNullSafe(F.col("p_source")))
        .withColumn("copies", copies)
        .withColumn("taken", F.col("size") * F.col("copies"))
        .drop("p_source", "times", "cut")
    )


def sized_rows(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """The narrow rows that a mixture is planned on: key, source, size, h."""
    return df.select(
        F.col(key), F.col(source).alias("source"), word_count(text).alias("size"), row_hash(key, text).alias("h")
    )


def mix_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
) -> DataFrame:
    """``df``'s rows, each as often as the mixture takes it, with ``df``'s columns.

    Null texts have size 0 and, like texts without words, come as often as every row of their source
    does. A null source is a source of its own, the last. Rows that are equal in key and text have
    one hash and are taken together. An empty table stays empty. Other columns may have
    any name: they are set aside while the plan's own are in use.
    """
    sizes = stage(sized_rows(df, key, text, source).select("source", "size", "h"), "sizes")
    plan = mixture_plan(sizes, weights, cap)
    drop_staged(sizes)
    held = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(f"`{source}`").alias("source"),
        word_count(text).alias("size"),
        row_hash(key, text).alias("h"),
    )
    mixed = apply_mixture(held, plan)
    copies = F.explode(F.array_repeat("row", F.col("copies").cast("int")))
    return mixed.select(copies.alias("row")).select("row.*")
