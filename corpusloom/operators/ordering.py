"""Exact row order at scale: the place of every row, and bounded segments of consecutive rows.

Batches are runs of consecutive rows, so every row needs its place in the whole table. A
global ``row_number()`` would pull the whole table through one task, so places are
found from a narrow table of keys and token counts, in jobs that never touch the wide columns:

1. keys and counts are written once and cut into key ranges;
2. each range's rows and tokens are summed, and running sums over the ranges say what lies before each;
3. inside its range every key gets its rank, its batch, and the tokens before it in its batch;
4. segments are cut where the running weight passes a multiple: runs of consecutive rows that weigh about
   the same, whatever the lengths of the rows.

The keys that start a segment form a table. Few of them go into the plan as one sorted constant that each wide row
searches; of many, only every n-th does, and the rest are leaves that are joined by its number. The
wide rows then move once, hashed on the segment, and the places of their keys, hashed alike, join them there
without a further exchange.

The order key must be unique and not null; integers and strings are supported. Null and
repeated keys are refused by every operator that goes by position, at every size. Where one column
repeats, order by several: ``order_key`` makes one key of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.arrays import count_not_above, literal_array
from corpusloom.sources.store import stage

#: Segments of a table at most, about; the most that a batch may weigh before it is cut into several.
MAX_SEGMENTS = 262_144
MAX_SEGMENT_WEIGHT = 1 << 24
#: What a row weighs besides its tokens, so that segments are bounded in rows too.
ROW_WEIGHT = 16
#: Segment starts that go into the plan as a constant; the bytes of leaves that may be broadcast.
CONSTANT_KEYS = 4_096
BROADCAST_LEAVES = 64 << 20
MAX_SHARDS = 65_536
MAX_RANGES = 65_536
RANGE_ROWS = 100_000
SAMPLES_PER_RANGE = 20
MAX_SAMPLE = 500_000
TOP_KEYS = 1_000


def order_key(*columns: str) -> Column:
    """One sortable string for several non-negative integer columns."""
    return F.concat_ws(":", *[F.lpad(F.col(c).cast("string"), 19, "0") for c in columns])


@dataclass(frozen=True)
class Segments:
    """Places of the rows of a table, and how its wide rows find them.

    ``places`` is ``(order, segment, batch_id, batch_row, start, n)``: ``start`` counts the tokens before the row in its
    batch, ``n`` its own. ``split`` says that some batch lies in several segments; otherwise each lies inside one.
    """

    order: str
    key_type: str
    rows: int
    places: DataFrame
    keys: list
    numbers: list
    split: bool = False
    leaves: DataFrame | None = None
    leaf_keys: int = 0

    @property
    def batch_keys(self) -> list[str]:
        """Grouping columns for a batch; with ``segment`` among them no exchange is needed."""
        return ["batch_id"] if self.split else ["segment", "batch_id"]

    def locate(self, df: DataFrame) -> DataFrame:
        """``df`` with the ``segment`` of each row, from its order key: the last start that is not above it."""
        if not self.keys:
            return df.withColumn("segment", F.lit(0).cast("bigint"))
        known = literal_array(self.keys, self.key_type)
        above = count_not_above(known, len(self.keys), F.col(self.order)) - 1
        number = F.get(literal_array(self.numbers, "bigint"), above)
        if self.leaves is None:
            return df.withColumn("segment", number)
        met = df.withColumn("_leaf", number).join(self.leaves, "_leaf")
        at = count_not_above(F.col("_starts"), self.leaf_keys, F.col(self.order)) - 1
        return met.withColumn("segment", F.get("_numbers", at)).drop("_leaf", "_starts", "_numbers")

    def attach(self, df: DataFrame, places: DataFrame | None = None) -> DataFrame:
        """``df`` with its places, by default ``segment, batch_id, batch_row, start``: one exchange of ``df``, hashed on
        ``segment``. The places are hashed on it too, so the join by key finds both sides where they are."""
        if places is None:
            places = self.places.drop("n")
        wide = self.locate(df).repartition("segment")
        return wide.join(places.repartition("segment"), ["segment", self.order])


def _with_rank(df: DataFrame, order: str, key_type: str, n: int) -> DataFrame:
    """Add the 0-based rank, and the running number of repeated keys inside a range."""
    ranges = min(MAX_RANGES, -(-n // RANGE_ROWS))
    cuts: list = []
    if ranges > 1:
        wanted = min(SAMPLES_PER_RANGE * ranges, MAX_SAMPLE)
        keys = df.select(order)
        sample = sorted(r[0] for r in keys.sample(min(1.0, wanted / n), seed=17).collect())
        step = max(1, len(sample) // ranges)
        cuts = sorted(set(sample[step::step]))
    offset = F.lit(0).cast("bigint")
    in_range = F.lit(0)
    if cuts:
        in_range = count_not_above(literal_array(cuts, key_type), len(cuts), F.col(order))
        sizes = dict(df.select(in_range.alias("_range")).groupBy("_range").count().collect())
        counts = [sizes.get(i, 0) for i in range(len(cuts) + 1)]
        before = literal_array([0, *accumulate(counts[:-1])], "bigint")
        offset = F.get(before, F.col("_range"))
    sorted_range = W.partitionBy("_range").orderBy(order)
    repeated = F.coalesce((F.lag(order).over(sorted_range) == F.col(order)).cast("int"), F.lit(0))
    return (
        df.withColumn("_range", in_range)
        .withColumn("_rank", offset + F.row_number().over(sorted_range) - 1)
        .withColumn("_repeat", repeated)
        .withColumn("_repeats", F.sum("_repeat").over(sorted_range.rowsBetween(W.unboundedPreceding, 0)))
        .drop("_range")
    )


def shard_starts(n: int, shards: int) -> list[int]:
    """First row of each contiguous shard; the first ``n % shards`` get one row more."""
    small, extra = divmod(n, shards)
    return [i * small + min(i, extra) for i in range(shards)]


def _keys(df: DataFrame, order: str) -> tuple[DataFrame, str]:
    keys = df.select(order)
    key_type = keys.schema[0].dataType.simpleString()
    if key_type not in ("tinyint", "smallint", "int", "bigint", "string"):
        raise TypeError(f"order key must be an integer or a string, not {key_type}")
    return keys, key_type


def check_keys(df: DataFrame, order: str) -> int:
    """The number of rows, if no order key is null or repeated. Counts are combined before the shuffle."""
    counted = df.groupBy(order).count()
    found = counted.agg(
        F.sum("count").alias("n"),
        F.sum(F.when(F.col(order).isNull(), F.col("count"))).alias("nulls"),
        F.max(F.when(F.col("count") > 1, F.col(order))).alias("repeated"),
    ).first()
    if found["nulls"]:
        raise ValueError(f"order key {order} is null in {found['nulls']} rows")
    if found["repeated"] is not None:
        raise ValueError(f"order key {order} is not unique, for example {found['repeated']!r}")
    return found["n"] or 0


def key_at(df: DataFrame, order: str, rank: int):
    """The order key of the row at a 0-based rank, or None past the end.

    Null and repeated keys are refused. Near the start every task then sends its few lowest keys;
    further on all keys are ranked.
    """
    keys, key_type = _keys(df, order)
    n = check_keys(keys, order)
    if rank >= n:
        return None
    if rank < TOP_KEYS:
        return keys.orderBy(order).offset(rank).limit(1).first()[order]
    return _with_rank(keys, order, key_type, n).where(F.col("_rank") == rank).first()[order]


def _ranged(keys: DataFrame, order: str, n: int) -> tuple[DataFrame, DataFrame | None]:
    """Keys with the key range they lie in (``_range``), and of several ranges what lies before each."""
    ranges = min(MAX_RANGES, -(-n // RANGE_ROWS))
    if ranges <= 1:
        return keys.withColumn("_range", F.lit(0)), None
    ranged = stage(keys.repartitionByRange(ranges, order).withColumn("_range", F.spark_partition_id()), "key-ranges")
    sums = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), F.sum("n").alias("_tokens"))
    # One row for each range is left.
    earlier = W.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_rows", "_tokens")]
    return ranged, stage(sums.select("_range", *before), "range-sums")


def _div(a: Column, b) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("bigint"))


def _batches(rank: Column, n: int, batch_rows: int, shards: int) -> tuple[Column, Column]:
    """(batch, row in it) of the row at ``rank``: batches restart in each of ``shards`` contiguous shards, of which
    the first ``n % shards`` have one row more."""
    small, extra = divmod(n, shards)
    larger = extra * (small + 1)
    in_larger = rank < larger
    shard = F.when(in_larger, _div(rank, small + 1)).otherwise(extra + _div(rank - larger, max(small, 1)))
    first = F.when(in_larger, shard * (small + 1)).otherwise(larger + (shard - extra) * small)
    per_larger, per_small = -(-(small + 1) // batch_rows), -(-small // batch_rows)
    earlier = F.when(in_larger, shard * per_larger).otherwise(extra * per_larger + (shard - extra) * per_small)
    in_shard = rank - first
    return earlier + _div(in_shard, batch_rows), in_shard % batch_rows


def _placed(keys: DataFrame, order: str, n: int, total: int, batch_rows: int, shards: int, max_segments: int) -> DataFrame:
    """Places of ``keys`` (order, n), with ``_repeat`` where a key equals the one before."""
    ranged, sums = _ranged(keys, order, n)
    in_range = W.partitionBy("_range").orderBy(order)
    so_far = in_range.rowsBetween(W.unboundedPreceding, 0)
    rank, tokens = F.row_number().over(in_range).cast("bigint") - 1, F.sum("n").over(so_far) - F.col("n")
    rows = ranged.select(
        order, "n", "_range", rank.alias("_rank"), tokens.alias("_tokens"),
        F.coalesce(F.lag(order).over(in_range) == F.col(order), F.lit(False)).alias("_repeat"),
    )
    if sums is not None:
        rows = rows.join(sums, "_range").withColumns(
            {"_rank": F.col("_rank") + F.col("_rows_before"), "_tokens": F.col("_tokens") + F.col("_tokens_before")}
        )
    batch, batch_row = _batches(F.col("_rank"), n, batch_rows, shards)
    rows = rows.withColumn("batch_id", batch).withColumn("batch_row", batch_row)
    # Sums never fall, so the tokens before a row's batch are the most seen at a first row.
    opening = F.when(F.col("batch_row") == 0, F.col("_tokens"))
    opened = F.max(opening).over(so_far)
    if sums is not None:
        rows = stage(rows, "ranked-keys")
        last = rows.groupBy("_range").agg(F.max(opening).alias("_opened"))
        earlier = W.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
        rows = rows.join(last.select("_range", F.max("_opened").over(earlier).alias("_carried")), "_range")
        opened = F.coalesce(opened, F.col("_carried"))
    rows = rows.withColumn("start", F.col("_tokens") - opened)
    # A batch heavier than a segment may be goes on in further ones; a position in steps of that weight never falls.
    steps = _div(F.col("start") + F.col("batch_row") * ROW_WEIGHT, MAX_SEGMENT_WEIGHT)
    opening_weight = F.col("_tokens") - F.col("start") + (F.col("_rank") - F.col("batch_row")) * ROW_WEIGHT
    size = max(1, -(-(total + n * ROW_WEIGHT) // max_segments))
    return rows.select(
        order, _div(opening_weight + steps * MAX_SEGMENT_WEIGHT, size).alias("segment"),
        "batch_id", "batch_row", "start", "n", (steps > 0).alias("_split"), "_repeat",
    )


def plan_segments(
    df: DataFrame,
    order: str,
    batch_rows: int,
    shards: int = 1,
    max_segments: int = MAX_SEGMENTS,
    counts: Column | None = None,
) -> Segments:
    """Places for batches of ``batch_rows`` consecutive rows inside each of ``shards`` contiguous shards.

    ``counts`` gives the tokens of a row, 0 if null; without it rows have none. The order key and what ``counts`` needs
    are read once and written as a narrow table, from which all else is found, so a costly
    ``df`` is worked out once here and once for its wide rows.

    A segment is a run of consecutive rows. It weighs at most (total weight) / ``max_segments`` +
    ``MAX_SEGMENT_WEIGHT`` and one row, where a row weighs its tokens + ``ROW_WEIGHT``. It holds whole batches unless one of
    them weighs more than ``MAX_SEGMENT_WEIGHT``. The driver gets ``CONSTANT_KEYS`` start keys at most.
    """
    if batch_rows < 1 or shards < 1:
        raise ValueError("batch_rows and shards must be positive")
    if shards > MAX_SHARDS:
        raise ValueError(f"at most {MAX_SHARDS} shards")
    _, key_type = _keys(df, order)
    n_tokens = F.lit(0) if counts is None else F.coalesce(counts, F.lit(0))
    keys = stage(df.select(order, n_tokens.cast("bigint").alias("n")), "keys")
    sizes = keys.agg(
        F.count(F.lit(1)).alias("rows"), F.count(order).alias("keyed"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")
    ).first()
    n, total = sizes["rows"], sizes["tokens"]
    if sizes["keyed"] < n:
        raise ValueError(f"order key {order} is null in {n - sizes['keyed']} rows")
    placed = _placed(keys, order, n, total, batch_rows, shards, max_segments)
    if n > RANGE_ROWS:
        placed = stage(placed, "places")
    starts = placed.groupBy("segment").agg(
        F.min(order).alias("key"), F.max("_split").alias("split"), F.max(F.when(F.col("_repeat"), F.col(order))).alias("repeated")
    )
    places = placed.drop("_split", "_repeat")
    # A segment opens at a batch, or inside one for each further weight that it may have.
    most = -(-n // batch_rows) + shards + (total + n * ROW_WEIGHT) // MAX_SEGMENT_WEIGHT
    if min(most, max_segments) > CONSTANT_KEYS:
        starts = stage(starts, "segment-starts")
    else:
        found = sorted(starts.collect())
        _refuse_repeated(order, [r["repeated"] for r in found])
        split = any(r["split"] for r in found)
        return Segments(order, key_type, n, places, [r["key"] for r in found], [r["segment"] for r in found], split)
    facts = starts.agg(F.max("repeated"), F.max("split"), F.count(F.lit(1)), F.max("segment"), F.sum(F.length(F.col("key").cast("string"))))
    repeated, split, n_starts, last, key_bytes = facts.first()
    _refuse_repeated(order, [repeated])
    # Leaves: short sorted runs of starts. The constant has the first key of each.
    width = -(-(last + 1) // CONSTANT_KEYS)
    runs = starts.groupBy(_div(F.col("segment"), width).alias("_leaf")).agg(
        F.sort_array(F.collect_list(F.struct("key", "segment"))).alias("_run")
    )
    leaves = runs.select("_leaf", F.col("_run.key").alias("_starts"), F.col("_run.segment").alias("_numbers"))
    if key_bytes + 24 * n_starts <= BROADCAST_LEAVES:
        leaves = F.broadcast(leaves)
    found = sorted(tuple(r) for r in runs.select("_leaf", F.get("_run", F.lit(0))["key"]).collect())
    return Segments(order, key_type, n, places, [k for _, k in found], [n for n, _ in found], split, leaves, width)


def _refuse_repeated(order: str, found: list) -> None:
    for key in found:
        if key is not None:
            raise ValueError(f"order key {order} is not unique, for example {key!r}")


def assign_batches(df: DataFrame, order: str, batch_rows: int, **options) -> DataFrame:
    """Add ``segment``, ``batch_id`` and ``batch_row``; one shuffle, hashed on ``segment``.
    ``options`` are those of :func:`plan_segments`."""
    plan = plan_segments(df, order, batch_rows, **options)
    return plan.attach(df, plan.places.drop("n", "start"))
