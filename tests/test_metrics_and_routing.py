import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import metrics, ordering, routing
from corpusloom.operators.dialogue import preference_rows, query_response_text, reward_stats
from corpusloom.operators.metrics import label_losses, long_cross_entropy, long_label_losses, long_masked_cross_entropy
from corpusloom.operators.tokens import estimate_sources, source_report
from corpusloom.operators.udf import filter_rows, map_batch_chunks, map_batches, map_rows


def test_bin_counts_split_at_input_length(spark):
    df = spark.createDataFrame([(1, [7, 7, 8, 7]), (2, [])], "k int, input_ids array<int>")
    got = {(r.k, r.part, r.token): r.n for r in metrics.token_bin_counts(df, ["k"], 2).collect()}
    assert got == {(1, "prompt", 7): 2, (1, "output", 8): 1, (1, "output", 7): 1}
    ratios = {r.k: r.repetition_ratio for r in metrics.repetition_ratio(df, ["k"]).collect()}
    assert ratios == {1: 0.5, 2: None}


def test_cross_entropy(spark):
    schema = "scores array<double>, label int"
    df = spark.createDataFrame([([2.0, 0.5, 0.3], 0), ([1000.0, 1000.0], 1), ([1.0], -100)], schema)
    row = metrics.masked_cross_entropy(df).first()
    first = math.log(sum(math.exp(z) for z in (2.0, 0.5, 0.3))) - 2.0
    assert row.num_labels == 2 and row.loss == pytest.approx((first + math.log(2)) / 2)
    ignored = metrics.masked_cross_entropy(df.where("label = -100")).first()
    assert ignored.loss is None and ignored.num_labels == 0


def test_losses(spark):
    rng = np.random.default_rng(0)
    z, y = rng.normal(size=(20, 3)) * 30, (rng.random((20, 3)) > 0.5).astype(float)
    schema = "scores array<double>, labels array<double>"
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(z, y)], schema)
    p = metrics.label_losses(df, metrics.problem_type(3, False)).first()
    bce = np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))
    assert p.loss == pytest.approx(bce.mean()) and p.num_rows == 20
    assert metrics.label_losses(df, "regression").first().loss == pytest.approx(((z - y) ** 2).mean())
    one = spark.createDataFrame([(a.tolist(), int(i % 3)) for i, a in enumerate(z)], "scores array<double>, labels int")
    logsum = np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1)
    expected = (logsum - z[np.arange(20), np.arange(20) % 3]).mean()
    assert metrics.label_losses(one, metrics.problem_type(3, True)).first().loss == pytest.approx(expected)
    assert metrics.problem_type(1, True) == "regression"
    with pytest.raises(ValueError):
        metrics.label_losses(df, "other")


def test_annotations(spark):
    text = "x <<a=1+\n2>> y <<b>> z << c = d=e>> <<open"
    df = spark.createDataFrame([(1, text), (2, "none")], "k int, text string")
    rows = {r.k: r for r in metrics.calc_annotations(df, ["k"]).collect()}
    assert [tuple(a) for a in rows[1].annotations] == [("a", "1+\n2"), ("b", None), (" c ", " d=e")]
    assert rows[1].clean_text == "x  y  z  <<open"
    assert rows[2].annotations == [] and rows[2].clean_text == "none"


def loop_route(v, c, groups, bias, k, top_groups, scale):
    scores = 1 / (1 + np.exp(-(c @ v)))
    choice = scores + bias
    names = sorted(set(groups))
    best = {g: sum(sorted((choice[i] for i in range(len(c)) if groups[i] == g), reverse=True)[:2]) for g in names}
    chosen = sorted(names, key=lambda g: (-best[g], g))[:top_groups]
    masked = [choice[i] if groups[i] in chosen else 0.0 for i in range(len(c))]
    top = sorted(range(len(c)), key=lambda i: (-masked[i], i))[:k]
    total = sum(scores[i] for i in top) + 1e-20 if k > 1 else 1.0
    return [(i, scores[i] / total * scale) for i in top]


@pytest.mark.parametrize("k, top_groups", [(1, 1), (3, 2), (5, 1)])
def test_routing(spark, k, top_groups):
    rng = np.random.default_rng(2)
    v, c = rng.normal(size=(40, 6)), rng.normal(size=(8, 6))
    groups, bias = [0, 0, 1, 1, 1, 2, 2, 2], rng.normal(size=8) * 0.1
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(99, None)], "id int, vector array<double>")
    cents = spark.createDataFrame(
        [(i, groups[i], float(bias[i]), c[i].tolist()) for i in range(8)],
        "bucket int, grp int, bias double, vector array<double>",
    )
    routes = routing.route_topk(vectors, cents, ["id"], top_k=k, top_groups=top_groups, scale=2.0)
    got = {}
    for r in routes.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.bucket, r.weight))
    assert set(got) == set(range(40))
    for i in range(40):
        expected = loop_route(v[i], c, groups, bias, k, top_groups, 2.0)
        assert [b for b, _ in got[i]] == [b for b, _ in expected]
        assert [w for _, w in got[i]] == pytest.approx([w for _, w in expected])
    load = {r.bucket: r.load for r in routing.route_load(routes, cents).collect()}
    assert set(load) == set(range(8)) and sum(load.values()) == 40 * k


def test_too_many_centroids(spark, monkeypatch):
    monkeypatch.setattr(routing, "MAX_CENTROIDS", 2)
    cents = spark.createDataFrame([(i, 0, [1.0]) for i in range(3)], "bucket int, grp int, vector array<double>")
    with pytest.raises(ValueError):
        routing.route_topk(spark.createDataFrame([(1, [1.0])], "id int, vector array<double>"), cents, ["id"])


def test_preference_and_reward(spark):
    df = spark.createDataFrame([(1, "p q r", "c d", "e")], "k int, prompt string, chosen string, rejected string")
    row = preference_rows(df, ["k"], 2).first()
    assert (row.prompt_ids, row.chosen_ids, row.rejected_ids) == (["p", "q"], ["c", "d"], ["e"])
    assert query_response_text(df, ["k"], "prompt", "chosen").first().text == "p q rc d"
    rewards = spark.createDataFrame([(i, i * 10) for i in range(7)], "k bigint, reward int")
    got = {r.batch_id: (r.num_rows, r.mean_reward, r.std_reward, r.min_reward, r.max_reward) for r in reward_stats(rewards, "k", 3).collect()}
    assert got == {0: (3, 10.0, 10.0, 0, 20), 1: (3, 40.0, 10.0, 30, 50), 2: (1, 60.0, None, 60, 60)}


def test_user_functions(spark):
    df = spark.range(10).repartition(3)
    doubled = map_batches(df, lambda b: {"x": [v for i in b["id"] for v in (i, -i)]}, "x bigint", ["id"])
    assert sorted(r.x for r in doubled.collect()) == sorted([*range(10), *(-i for i in range(10))])
    named = map_rows(df, lambda i: [f"n{i}"] * 2, ["id"], "n", "array<string>")
    assert {r.id: r.n for r in named.collect()}[4] == ["n4", "n4"]
    assert sorted(r.id for r in filter_rows(df, lambda i: i > 6, ["id"]).collect()) == [7, 8, 9]


def test_user_functions_see_plain_values(spark):
    df = spark.createDataFrame([(1, None, [1, 2]), (None, "x", None)], "i int, s string, a array<int>").coalesce(1)
    seen = map_rows(df, lambda i, s, a: repr((i, s, a)), ["i", "s", "a"], "r", "string")
    assert [r.r for r in seen.collect()] == ["(1, None, [1, 2])", "(None, 'x', None)"]
    shapes = map_batches(df, lambda b: {"r": [repr(b["i"]), repr(b["a"])], "n": [None, 2]}, "r string, n int")
    assert [(r.r, r.n) for r in shapes.collect()] == [("[1, None]", None), ("[[1, 2], None]", 2)]
    assert filter_rows(df, lambda i: i is None, ["i"]).count() == 1
    nested = map_rows(df, lambda i: {"k": i, "xs": [i]}, ["i"], "o", "struct<k: int, xs: array<int>>")
    assert nested.first().o.xs == [1]


def test_ordered_batches_have_their_size(spark):
    df = spark.createDataFrame([(i * 7 % 10, str(i * 7 % 10)) for i in range(10)], "k int, x string")

    def joined(batch):
        return {"b": [batch["batch_id"][0]], "x": ["".join(batch["x"])]}

    got = map_batches(df, joined, "b bigint, x string", ["x"], order="k", batch_rows=4)
    assert sorted(map(tuple, got.collect())) == [(0, "0123"), (1, "4567"), (2, "89")]
    with pytest.raises(ValueError):
        map_batches(df, joined, "b bigint, x string", ["x"], order="k")
    with pytest.raises(ValueError, match="not unique"):
        map_batches(df.union(df), joined, "b bigint, x string", ["x"], order="k", batch_rows=100)


def test_chunked_batches_come_in_order(spark):
    """A batch far larger than a chunk is never in the worker as a whole."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.range(900).select((F.col("id") * 7 % 900).alias("k"), F.repeat(F.lit("x"), 100_000).alias("x")).repartition(5)

    def sums(chunks):
        import resource

        start, rows, n, largest = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, [], 0, 0
        for chunk in chunks:
            rows += chunk["k"]
            n += sum(map(len, chunk["x"]))
            largest = max(largest, len(chunk["k"]))
        grown = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start
        yield {"b": [chunk["batch_id"][0]], "n": [n], "sorted": [rows == list(range(rows[0], rows[0] + len(rows)))],
               "largest": [largest], "grown": [grown]}

    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
        found = map_batch_chunks(df, sums, "b bigint, n bigint, sorted boolean, largest int, grown bigint", "k", 600, ["k", "x"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(r.b, r.n, r.sorted, r.largest <= 20) for r in found} == {(0, 60_000_000, True, True), (1, 30_000_000, True, True)}
    assert max(r.grown for r in found) < 30_000


def test_chunked_batches_over_several_segments(spark, monkeypatch):
    monkeypatch.setattr(ordering, "MAX_SEGMENT_WEIGHT", 400)
    df = spark.range(300).select(F.col("id").alias("k"))

    def first_and_last(chunks):
        rows = [k for chunk in chunks for k in chunk["k"]]
        yield {"a": [rows[0]], "z": [rows[-1]], "n": [len(rows)]}

    found = map_batch_chunks(df, first_and_last, "a bigint, z bigint, n int", "k", 120)
    assert sorted(map(tuple, found.collect())) == [(0, 119, 120), (120, 239, 120), (240, 299, 60)]


def test_long_form_losses(spark):
    rng = np.random.default_rng(4)
    rows, expected = [], {}
    for k in range(40):
        z = rng.normal(size=30) * rng.choice([1, 300, 5000]) + rng.choice([0, -1e6, 1e6])
        y = int(rng.integers(30)) if k % 5 else -100
        rows += [(k, k % 3, y, i, float(v)) for i, v in enumerate(z)]
        expected[k] = None if y == -100 else float(z.max() + np.log(np.exp(z - z.max()).sum()) - z[y])
    rows += [(90, 0, 1, 0, float("-inf")), (90, 0, 1, 1, 2.0), (91, 0, 1, 0, float("nan")), (91, 0, 1, 1, 0.0), (92, 0, 7, 0, 1.0)]
    rows += [(93, 0, None, 0, 1.0), (94, 0, 0, 0, 3.0), (94, 0, 0, 1, None)]
    df = spark.createDataFrame(rows, "k int, g int, label int, token int, score double").repartition(7)
    got = {r.k: r.loss for r in long_cross_entropy(df, ["k"]).collect()}
    for k, loss in expected.items():
        assert got[k] == (None if loss is None else pytest.approx(loss, rel=1e-9, abs=1e-6))
    assert got[90] == 0.0 and np.isnan(got[91]) and got[92] is None and got[93] is None and got[94] == 0.0
    whole = long_masked_cross_entropy(df.where("k < 40"), ["k", "g"], by=["g"]).collect()
    for r in whole:
        own = [loss for k, loss in expected.items() if k % 3 == r.g and loss is not None]
        assert r.num_labels == len(own) and r.loss == pytest.approx(np.mean(own))
    assert long_masked_cross_entropy(df.where("false"), ["k"]).first().num_labels == 0


def test_long_form_equals_arrays(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4).tolist(), rng.integers(0, 2, 4).astype(float).tolist(), int(rng.integers(4))) for i in range(25)]
    df = spark.createDataFrame(rows, "k int, scores array<double>, labels array<double>, y int")
    long = df.select("k", "y", F.posexplode(F.arrays_zip("scores", "labels")).alias("entry", "p"))
    long = long.select("k", "y", "entry", F.col("p.scores").alias("score"), F.col("p.labels").alias("label"))
    for kind in ("regression", "multi_label_classification"):
        a, b = label_losses(df, kind).first(), long_label_losses(long, kind, ["k"]).first()
        assert (a.problem_type, a.num_rows) == (b.problem_type, b.num_rows) and a.loss == pytest.approx(b.loss)
    kind = "single_label_classification"
    a = label_losses(df.withColumn("labels", F.col("y")), kind).first()
    b = long_label_losses(long.withColumn("label", F.col("y")), kind, ["k"]).first()
    assert a.num_rows == b.num_rows and a.loss == pytest.approx(b.loss)


def test_sampled_estimates(spark):
    """The same rows at every partitioning, combined before the shuffle; most intervals hold the truth."""
    rng = np.random.default_rng(5)
    rows = [(i, f"s{i % 30}" if i % 31 else None, " ".join("w" * int(n))) for i, n in enumerate(rng.integers(0, 60, 6000))]
    df = spark.createDataFrame(rows, "k int, source string, text string")
    found = [sorted(estimate_sources(df.repartition(n), "text", ["source"], "k", 60).collect(), key=str) for n in (1, 3, 8)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 31
    truth = {r.source: r.total_tokens for r in source_report(df, "text", ["source"]).collect()}
    inside = [r.low <= truth[r.source] <= r.high for r in found[0]]
    assert sum(inside) >= 25
    whole = estimate_sources(df, "text", ["source"], "k", 10_000).collect()
    assert all(r.std_error == 0 and r.estimated_tokens == pytest.approx(truth[r.source]) for r in whole)
    plan = estimate_sources(df, "text", ["source"], "k", 60)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert estimate_sources(df.where("false"), "text", ["source"], "k").count() == 0


def test_load_without_routes(spark):
    cents = spark.createDataFrame([(i, 0, [1.0]) for i in range(3)], "bucket int, grp int, vector array<double>")
    none = spark.createDataFrame([], "bucket int")
    assert sorted(map(tuple, routing.route_load(none, cents).collect())) == [(0, 0, None), (1, 0, None), (2, 0, None)]
