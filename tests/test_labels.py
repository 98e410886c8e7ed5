"""Labels and sequence columns against plain loops."""

import random
import time

from pyspark.sql import functions as F

from corpusloom.operators import labels as m
from corpusloom.operators import ordering

# The token ids of one system/user/assistant sample and its two markers.
GOLDEN = [
    151644, 8948, 198, 2610, 525, 264, 10950, 17847, 11, 3465, 553, 3960, 17, 776, 0, 151645, 198,
    151644, 872, 198, 44063, 87752, 99534, 16744, 101047, 55338, 2073, 285, 854, 27733, 99689,
    109762, 2073, 16123, 854, 8997, 785, 19145, 374, 17923, 323, 279, 4349, 374, 2238, 13, 576,
    9853, 12644, 374, 49584, 304, 279, 7015, 323, 279, 29464, 1021, 374, 35918, 13, 151645, 198,
    151644, 77091, 198, 151667, 271, 151668, 271, 785, 19145, 572, 17923, 323, 279, 4349, 572,
    2238, 13, 576, 9853, 12644, 572, 49584, 304, 279, 7015, 323, 279, 29464, 1021, 572, 35918, 13,
    151645, 198,
]
USER, ASSISTANT = [151644, 872], [151644, 77091]


def ids_table(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "k int, input_ids array<int>")


def column(df, name):
    return [r[name] for r in df.orderBy("k").collect()]


def test_golden(spark):
    df = m.completion_labels(ids_table(spark, [GOLDEN]), USER, ASSISTANT)
    (labels,) = column(df, "labels")
    assert labels == [-100] * 65 + GOLDEN[65:]
    assert m.supervised_token_count(df, ["k"]).first().supervised_tokens == 32
    pairs = m.next_token_pairs(df, ["k"]).orderBy("pos").collect()
    assert [p.label for p in pairs] == GOLDEN[65:] and [p.token for p in pairs] == GOLDEN[64:-1]


def loop_labels(ids, user, assistant):
    def find(marker):
        return [i for i in range(len(ids)) if ids[i : i + len(marker)] == marker]

    h, r = find(user), [i + len(assistant) for i in find(assistant)]
    if not h or not r:
        return [-100] * len(ids)
    out = list(ids)
    if h[0] > r[0]:
        h = [0] + h
    for i in range(min(r[0], len(out))):
        out[i] = -100
    for a, b in zip(h, r):
        for i in range(a, min(b, len(out))):
            out[i] = -100
    if len(h) > len(r):
        out[h[-1] :] = [-100] * (len(out) - h[-1])
    return out


def test_random_markers(spark):
    rng = random.Random(11)
    rows = [[rng.choice([1, 2, 3, 4]) for _ in range(rng.randrange(30))] for _ in range(400)]
    got = column(m.completion_labels(ids_table(spark, rows), [1, 2], [1, 3]), "labels")
    assert got == [loop_labels(r, [1, 2], [1, 3]) for r in rows]
    got = column(m.completion_labels(ids_table(spark, rows), [1], [3]), "labels")
    assert got == [loop_labels(r, [1], [3]) for r in rows]


def test_padding_and_causal(spark):
    df = m.pad_batch(ids_table(spark, [[5, 6], [], [1, 2, 3]]), 3, 0)
    assert column(df, "input_ids") == [[5, 6, 0], [0, 0, 0], [1, 2, 3]]
    assert column(df, "attention_mask") == [[1, 1, 0], [0, 0, 0], [1, 1, 1]]
    assert column(m.causal_labels(df, 0), "labels") == [[5, 6, -100], [-100] * 3, [1, 2, 3]]


def test_position_ids(spark):
    rng = random.Random(1)
    masks = [[0, 0, 1, 1, 1], [1, 0, 1], [], None, [0]]
    masks += [[rng.randrange(2) for _ in range(rng.randrange(60))] for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(masks)), "k int, attention_mask array<int>")
    got = column(m.position_ids(df), "position_ids")
    assert got[:5] == [[1, 1, 0, 1, 2], [0, 1, 1], [], None, [1]]
    assert got == [
        None if x is None else [sum(x[: i + 1]) - 1 if v else 1 for i, v in enumerate(x)] for x in masks
    ]


def test_offsets(spark):
    masks = [[1, 1, 1, 0], [0, 0, 1, 1], [1, 1, 1, 1]]
    empty = spark.createDataFrame([(0, [])], "k int, attention_mask array<int>")
    assert m.sequence_offsets(empty, "k", 3).first().flat_indices == []
    df = spark.createDataFrame(list(enumerate(masks)), "k int, attention_mask array<int>")
    rows = m.sequence_offsets(df, "k", 3).orderBy("k").collect()
    assert [rows[0].start_offset] + [r.end_offset for r in rows] == [0, 3, 5, 9]
    assert {r.max_seqlen for r in rows} == {4}
    flat = [x for mask in masks for x in mask]
    assert [i for r in rows for i in r.flat_indices] == [i for i, x in enumerate(flat) if x]


def test_offsets_of_long_batches(spark, monkeypatch):
    rng = random.Random(3)
    masks = [[rng.randrange(2) for _ in range(12)] for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(masks)), "k int, attention_mask array<int>")
    whole = m.sequence_offsets(df, "k", 40).orderBy("k").collect()
    monkeypatch.setattr(ordering, "MAX_SEGMENT_WEIGHT", 150)
    assert m.sequence_offsets(df, "k", 40).orderBy("k").collect() == whole
    assert whole[39].end_offset == sum(map(sum, masks[:40])) and whole[40].start_offset == 0


def test_last_valid_index(spark):
    rows = [[1, 2, 3, 4, 5], [1, 2, 0, 0, 0], [0, 1, 2, 3, 4]]
    assert column(m.last_valid_index(ids_table(spark, rows), 0), "last_index") == [4, 1, 4]


def test_ignored_next_tokens(spark):
    df = ids_table(spark, [[1, 2, 3], [4], []]).withColumn(
        "labels", F.transform("input_ids", lambda x: F.when(x == 2, -100).otherwise(x))
    )
    got = [(r.k, r.pos, r.token, r.label) for r in m.next_token_pairs(df, ["k"]).collect()]
    assert got == [(0, 1, 2, 3)]


def test_pad_longest_pads_each_batch_to_its_own_longest(spark):
    rows = [(0, [7]), (1, [8, 9, 9]), (2, None), (3, []), (4, [5, 5])]
    df = spark.createDataFrame(rows, "k int, input_ids array<int>")
    got = {r.k: r for r in m.pad_longest(df, 0, "k", 2).collect()}
    assert [got[k].batch_id for k in range(5)] == [0, 0, 1, 1, 2]
    assert got[0].input_ids == [7, 0, 0] and got[0].attention_mask == [1, 0, 0]
    assert got[1].input_ids == [8, 9, 9] and got[4].input_ids == [5, 5]
    assert got[2].input_ids is None and got[3].input_ids == []


def test_pad_longest_over_batches_longer_than_segments(spark, monkeypatch):
    df = spark.createDataFrame([(i, [1] * (i % 5)) for i in range(40)], "k int, input_ids array<int>")
    whole = sorted(m.pad_longest(df, 0, "k", 20).collect())
    monkeypatch.setattr(ordering, "MAX_SEGMENT_WEIGHT", 150)
    assert sorted(m.pad_longest(df, 0, "k", 20).collect()) == whole
    assert {len(r.input_ids) for r in whole} == {4}


def test_labels_take_time_in_proportion(spark):
    """Ten times the turns take about ten times the time: every border is met once."""

    def seconds(turns):
        ids = ([*USER, 1, 2, 3, 4, *ASSISTANT, 5, 6, 7]) * turns
        df = m.completion_labels(ids_table(spark, [ids]).repartition(1).cache(), USER, ASSISTANT)
        best = []
        for _ in range(3):
            start = time.perf_counter()
            (found,) = column(df.withColumn("labels", F.filter("labels", lambda x: x != -100)), "labels")
            best.append(time.perf_counter() - start)
        assert found == [5, 6, 7] * turns
        return min(best)

    seconds(100)
    short, long = seconds(1000), seconds(10_000)
    assert long < 25 * max(short, 0.1)


def test_label_plan_meets_no_span_for_every_token(spark):
    df = m.completion_labels(ids_table(spark, [GOLDEN]), USER, ASSISTANT)
    assert "exists(" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_labels_of_null_and_empty_rows(spark):
    df = m.completion_labels(ids_table(spark, [None, [], [1], [*USER, 4], [*USER, 4, *ASSISTANT], GOLDEN]), USER, ASSISTANT)
    labels = column(df, "labels")
    assert labels[0] is None and labels[1] == [] and labels[2] == [-100] and labels[3] == [-100] * 3 and labels[4] == [-100] * 5
