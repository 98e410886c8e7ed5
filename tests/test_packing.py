"""Packing against the place of every token: edges, shards, segment and range boundaries."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.tokenizers import BYTES
from corpusloom.operators import ordering
from corpusloom.operators.ordering import assign_batches, key_at, order_key, plan_segments
from corpusloom.operators.packing import concat_sources, pack, pack_report, pack_text
from corpusloom.operators.quality import row_at, take


def expected_blocks(rows, seq_len, batch_rows, shards=1):
    """{(batch, block): tokens}, by the place of each token in its batch: place p belongs to block
    p // seq_len, which counts if it is full or the only one. rows: token lists in order."""
    ends = ordering.shard_starts(len(rows), shards)[1:] + [len(rows)]
    shard_of = lambda r: sum(r >= e for e in ends)
    first = [0, *ends]
    place, batch_of = {}, {}
    for r, row in enumerate(rows):
        s = shard_of(r)
        earlier = sum(-(-(first[k + 1] - first[k]) // batch_rows) for k in range(s))
        batch_of[r] = earlier + (r - first[s]) // batch_rows
    blocks, size = {}, {}
    for r, row in enumerate(rows):
        for token in row:
            b = batch_of[r]
            place[b] = place.get(b, -1) + 1
            blocks.setdefault((b, place[b] // seq_len), []).append(token)
            size[b] = size.get(b, 0) + 1
    return {at: tokens for at, tokens in blocks.items() if len(tokens) == seq_len or size[at[0]] < seq_len}


def table(spark, rows, keys=None):
    keys = keys or list(range(len(rows)))
    data = list(zip(keys, rows))
    random.Random(1).shuffle(data)
    kind = "string" if keys and isinstance(keys[0], str) else "bigint"
    return spark.createDataFrame(data, f"k {kind}, input_ids array<int>").repartition(5)


def packed(df):
    return {(r.batch_id, r.block_id): r.input_ids for r in df.collect()}


@pytest.mark.parametrize(
    "lengths, blocks, dropped",
    [
        ([3, 5], 2, 0),
        ([3, 6], 2, 1),
        ([3], 1, 0),
        ([], 0, 0),
        ([0], 0, 0),
        ([2, 0, 2], 1, 0),
        ([11], 2, 3),
    ],
)
def test_edges(spark, lengths, blocks, dropped):
    rows, at = [], 0
    for n in lengths:
        rows.append(list(range(at, at + n)))
        at += n
    df = table(spark, rows)
    got = packed(pack(df, "k", 4, 10))
    assert got == expected_blocks(rows, 4, 10)
    assert len(got) == blocks
    report = pack_report(df.withColumn("num_tokens", F.size("input_ids")), "k", 4, 10).first()
    assert (report.blocks, report.dropped_tokens) == (blocks, dropped)
    assert report.kept_tokens + dropped == sum(lengths)


def random_rows(n, seed=5, longest=40):
    rng = random.Random(seed)
    lengths = [rng.choice([0, 1, 2, rng.randrange(longest), longest * 20 * (rng.random() < 0.02)]) for _ in range(n)]
    return [[rng.randrange(1000) for _ in range(int(k))] for k in lengths]


@pytest.mark.parametrize("batch_rows, shards, max_segments", [(7, 1, 1000), (16, 3, 4), (50, 7, 1), (1000, 1, 5), (1, 1, 9)])
def test_random(spark, batch_rows, shards, max_segments):
    rows = random_rows(311)
    got = packed(pack(table(spark, rows), "k", 16, batch_rows, shards=shards, max_segments=max_segments))
    assert got == expected_blocks(rows, 16, batch_rows, shards)


def test_many_ranges(spark, monkeypatch):
    """Ranks pieced together from sampled key ranges."""
    monkeypatch.setattr(ordering, "RANGE_ROWS", 20)
    rows = random_rows(523, seed=9)
    keys = sorted(random.Random(3).sample(range(10**12), len(rows)))
    df = table(spark, rows, keys)
    assert packed(pack(df, "k", 16, 10, shards=4)) == expected_blocks(rows, 16, 10, 4)
    assert packed(pack(df, "k", 16, 10)) == expected_blocks(rows, 16, 10)
    assert packed(pack(df, "k", 16, 1000)) == expected_blocks(rows, 16, 1000)
    monkeypatch.setattr(ordering, "TOP_KEYS", 5)
    assert [key_at(df, "k", i) for i in (0, 4, 5, 300, 522, 523)] == [
        keys[0], keys[4], keys[5], keys[300], keys[522], None,
    ]


@pytest.mark.parametrize("batch_rows, shards", [(100, 1), (1000, 1), (40, 3), (33, 1)])
def test_batches_longer_than_a_segment(spark, monkeypatch, batch_rows, shards):
    monkeypatch.setattr(ordering, "MAX_SEGMENT_WEIGHT", 600)
    rows = random_rows(250, seed=6)
    df = table(spark, rows)
    assert packed(pack(df, "k", 64, batch_rows, shards=shards)) == expected_blocks(rows, 64, batch_rows, shards)
    assert packed(pack(df, "k", 10**6, batch_rows, shards=shards)) == expected_blocks(rows, 10**6, batch_rows, shards)
    report = pack_report(df.withColumn("num_tokens", F.size("input_ids")), "k", 64, batch_rows, shards=shards).first()
    expected = expected_blocks(rows, 64, batch_rows, shards)
    assert (report.blocks, report.kept_tokens) == (len(expected), sum(map(len, expected.values())))


@pytest.mark.parametrize("ranges", [100_000, 40])
def test_segments_are_bounded_in_tokens(spark, monkeypatch, ranges):
    """A cluster of very long rows is cut into segments of its own; blocks stay the same."""
    monkeypatch.setattr(ordering, "MAX_SEGMENT_WEIGHT", 3000)
    monkeypatch.setattr(ordering, "RANGE_ROWS", ranges)
    rng = random.Random(8)
    rows = [[rng.randrange(99) for _ in range(900 if 100 <= i < 140 else rng.randrange(12))] for i in range(300)]
    df = table(spark, rows)
    for batch_rows, most in ((16, 4), (1, 4), (300, 9)):
        plan = plan_segments(df, "k", batch_rows, max_segments=most, counts=F.size("input_ids"))
        found = plan.places.collect()
        weight = {}
        for r in found:
            weight[r.segment] = weight.get(r.segment, 0) + r.n + ordering.ROW_WEIGHT
        total = sum(weight.values())
        assert max(weight.values()) <= -(-total // most) + 3000 + 900 + ordering.ROW_WEIGHT
        assert len(weight) <= most + 1
        # Segments are runs of consecutive rows.
        in_order = [r.segment for r in sorted(found, key=lambda r: r.k)]
        assert in_order == sorted(in_order)
        assert plan.split == (batch_rows > 1)
        assert packed(pack(df, "k", 64, batch_rows, max_segments=most)) == expected_blocks(rows, 64, batch_rows)


@pytest.mark.parametrize("broadcast", [1 << 26, 0])
@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_segment_starts_as_a_table(spark, monkeypatch, kind, broadcast):
    """More segments than constants: the same blocks by way of the leaves."""
    monkeypatch.setattr(ordering, "CONSTANT_KEYS", 8)
    monkeypatch.setattr(ordering, "BROADCAST_LEAVES", broadcast)
    rows = random_rows(400, seed=12)
    keys = sorted(random.Random(4).sample(range(10**9), len(rows)))
    keys = keys if kind == "bigint" else sorted(f"k{k}" for k in keys)
    plan = plan_segments(table(spark, rows, keys), "k", 3, counts=F.size("input_ids"))
    assert plan.leaves is not None and len(plan.keys) <= 9
    assert packed(pack(table(spark, rows, keys), "k", 16, 3)) == expected_blocks(rows, 16, 3)


def test_very_many_segments(spark):
    """200,000 segments, of which the driver gets a few thousand keys."""
    n = 200_000
    df = spark.range(n).select((F.col("id") * 7).alias("k"), F.array(F.col("id").cast("int")).alias("input_ids"))
    plan = plan_segments(df, "k", 1, counts=F.size("input_ids"))
    assert plan.places.select("segment").distinct().count() == n
    assert len(plan.keys) <= ordering.CONSTANT_KEYS + 1
    blocks = pack(df, "k", 1, 1)
    found = blocks.agg(F.count(F.lit(1)), F.sum((F.col("batch_id") == F.col("input_ids")[0]).cast("int"))).first()
    assert tuple(found) == (n, n)


def test_string_keys(spark):
    rows = random_rows(90, seed=2)
    keys = sorted(f"é{i}\U0001f600" if i % 2 else f"z{i}" for i in range(len(rows)))
    assert packed(pack(table(spark, rows, keys), "k", 16, 8)) == expected_blocks(rows, 16, 8)


def test_layout_does_not_matter(spark):
    df = table(spark, random_rows(200, seed=4))
    first = packed(pack(df, "k", 32, 25))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert packed(pack(df.repartition(1), "k", 32, 25)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_columns_stay_aligned(spark):
    df = table(spark, random_rows(60)).withColumn("twice", F.transform("input_ids", lambda x: x * 2))
    for r in pack(df, "k", 16, 9, ["input_ids", "twice"]).collect():
        assert r.twice == [2 * x for x in r.input_ids]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_null_texts_add_nothing(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    texts = ["a b c", None, "d", "", None, "e f"]
    df = spark.createDataFrame(list(enumerate(texts)), "k bigint, text string")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        assert packed(pack_text(df, "text", "k", 2, 10, mask=True)) == {
            (0, 0): ["a", "b"], (0, 1): ["c", "d"], (0, 2): ["e", "f"],
        }
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_text_is_not_cut(spark):
    """A document much longer than a block keeps every token."""
    text = "".join(chr(97 + i % 26) for i in range(100_000))
    df = spark.createDataFrame([(1, text), (2, "xyz")], "k bigint, text string")
    blocks = packed(pack_text(df, "text", "k", 1000, tokenizer=BYTES))
    assert bytes(b for k in sorted(blocks) for b in blocks[k]).decode() == text


def test_batches(spark):
    df = spark.range(1000).withColumn("k", order_key("id")).repartition(7)
    rows = assign_batches(df, "k", 64).collect()
    assert all(r.batch_id * 64 + r.batch_row == r.id for r in rows)
    assert len(rows) == 1000


def test_bounds(spark):
    plan = plan_segments(spark.range(5000).withColumnRenamed("id", "k"), "k", 10, max_segments=50)
    assert len(plan.keys) <= 50 and plan.rows == 5000
    with pytest.raises(TypeError):
        plan_segments(spark.range(5).select(F.col("id").cast("double").alias("k")), "k", 10)


@pytest.mark.parametrize("keys, match", [([1, 1, 1, 2], "not unique"), ([None, 1, 2], "null")])
@pytest.mark.parametrize("top_keys", [0, 1000])
def test_positions_refuse_bad_keys(spark, monkeypatch, keys, match, top_keys):
    monkeypatch.setattr(ordering, "TOP_KEYS", top_keys)
    df = spark.createDataFrame([(k, [i]) for i, k in enumerate(keys)], "k bigint, input_ids array<int>")
    for run in (
        lambda: take(df, 2, "k"),
        lambda: row_at(df, 0, "k"),
        lambda: pack(df, "k", 4, 2),
        lambda: pack(df, "k", 4, 100),
    ):
        with pytest.raises(ValueError, match=match):
            run()


def test_bad_keys_are_refused(spark, monkeypatch):
    df = spark.createDataFrame([(i % 30, [i]) for i in range(60)], "k bigint, input_ids array<int>")
    with pytest.raises(ValueError, match="not unique"):
        pack(df, "k", 4, 10)
    monkeypatch.setattr(ordering, "RANGE_ROWS", 10)
    with pytest.raises(ValueError, match="not unique"):
        pack(df, "k", 4, 10)
    nulls = spark.createDataFrame([(None, [1]), (1, [1])], "k bigint, input_ids array<int>")
    with pytest.raises(ValueError, match="null"):
        pack(nulls, "k", 4, 1)


def test_union_order(spark):
    a, b = spark.range(2), spark.range(3).withColumn("x", F.lit(1))
    rows = concat_sources({"b": b, "a": a}).orderBy("source_ord", "id").collect()
    assert [(r.source, r.id, r.x) for r in rows] == [
        ("b", 0, 1), ("b", 1, 1), ("b", 2, 1), ("a", 0, None), ("a", 1, None),
    ]
