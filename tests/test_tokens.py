import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.tokenizers import BYTES, WORDS, ExternalTokenizer, bpe_from_json
from corpusloom.operators import tokens as k


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "k int, text string").repartition(3)


def by_key(df, name):
    return {r.k: r[name] for r in df.collect()}


VALUES = ["a b\tc\n", "", " ", "é中\U0001f600 x", None, "a\r\na", "no break"]


def test_builtin_tokens(spark):
    df = texts(spark, VALUES)
    assert by_key(k.tokenize(df, "text", ["k"]), "input_ids") == {
        0: ["a", "b", "c"], 1: [], 2: [], 3: ["é中\U0001f600", "x"], 4: None, 5: ["a", "a"], 6: ["no break"],
    }
    got = by_key(k.tokenize(df, "text", ["k"], BYTES), "input_ids")
    assert got == {i: None if v is None else list(v.encode()) for i, v in enumerate(VALUES)}
    for tokenizer in (WORDS, BYTES):
        counts = by_key(k.token_count(df, "text", ["k"], tokenizer=tokenizer), "num_tokens")
        ids = by_key(k.tokenize(df, "text", ["k"], tokenizer), "input_ids")
        assert counts == {i: None if v is None else len(v) for i, v in ids.items()}


def test_pair_total_and_empty(spark):
    df = spark.createDataFrame([(0, "a b", "c"), (1, "", "d")], "k int, x string, y string")
    assert by_key(k.tokenize_pair(df, "x", "y", ["k"]), "input_ids") == {0: ["a", "b", "c"], 1: ["d"]}
    assert k.total_tokens(df, "x", "y").first().total_tokens == 4
    assert k.total_tokens(df.limit(0), "x").first().total_tokens == 0
    report = k.token_report(spark.createDataFrame([(1_872_137_976,)], "total_tokens bigint")).first()
    assert (report.billions, report.binary_billions) == ("1.872B", "1.743564b")


def test_estimate(spark):
    df = texts(spark, ["a " * (i + 1) for i in range(10)])
    row = k.estimate_total(df, "text", "k", 4).first()
    assert (row.sampled_rows, row.total_rows, row.avg_tokens, row.estimated_tokens) == (4, 10, 2.5, 25.0)


def random_words(n=60):
    rng = random.Random(4)
    return [" ".join(f"w{int(rng.paretovariate(0.7)) % 200}" for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("limit", [100_000, 5])
def test_vocabulary_round_trip(spark, monkeypatch, limit):
    """limit 5 sends all but five tokens through the join."""
    monkeypatch.setattr(k, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(k, "IN_PLACE_ROWS", limit)
    values = random_words() + [None]
    words = k.tokenize(texts(spark, values), "text", ["k"])
    vocabulary = k.vocab(words)
    counts = {}
    for v in values[:-1]:
        for t in v.split():
            counts[t] = counts.get(t, 0) + 1
    ranked = sorted(counts, key=lambda t: (-counts[t], t))
    assert {r.token: (r.freq, r.token_id) for r in vocabulary.collect()} == {
        t: (counts[t], i) for i, t in enumerate(ranked)
    }
    ids = k.encode_ids(words, vocabulary, "k")
    place = {t: i for i, t in enumerate(ranked)}
    expected = {i: [place[t] for t in v.split()] for i, v in enumerate(values[:-1])}
    got = by_key(ids, "input_ids")
    assert {i: got[i] for i in expected} == expected
    back = by_key(k.decode_ids(ids, vocabulary, "k"), "text")
    assert {i: back[i] for i in expected} == {i: " ".join(v.split()) for i, v in enumerate(values[:-1])}
    skipped = by_key(k.decode_ids(ids, vocabulary, "k", special_ids=[0, 2]), "text")
    assert {i: skipped[i] for i in expected} == {
        i: " ".join(t for t in v.split() if place[t] not in (0, 2)) for i, v in enumerate(values[:-1])
    }


@pytest.mark.parametrize("limit", [100_000, 3])
def test_small_vocabulary_leaves_nulls(spark, monkeypatch, limit):
    words = k.tokenize(texts(spark, ["a a b b c", "z a"]), "text", ["k"])
    vocabulary = k.vocab(words, max_size=2)
    monkeypatch.setattr(k, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(k, "IN_PLACE_ROWS", limit if limit > 10 else 1)
    assert by_key(k.encode_ids(words, vocabulary, "k"), "input_ids") == {0: [0, 0, 1, 1, None], 1: [None, 0]}


def test_external_tokenizer(spark):
    df = texts(spark, ["ab", None, "", "xyz"])
    lengths = ExternalTokenizer(lambda: lambda batch: [list(range(len(t))) for t in batch])
    assert by_key(k.tokenize(df, "text", ["k"], lengths), "input_ids") == {0: [0, 1], 1: None, 2: [], 3: [0, 1, 2]}


def test_trained_bpe(spark):
    """The same ids as the tokenizer itself, from its JSON definition alone."""
    tokenizers = pytest.importorskip("tokenizers")
    bpe = tokenizers.Tokenizer(tokenizers.models.BPE())
    bpe.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    values = random_words(40) + ["中国首都是哪?"]
    bpe.train_from_iterator(values, tokenizers.trainers.BpeTrainer(vocab_size=300, show_progress=False))
    df = texts(spark, values)
    got = by_key(k.tokenize(df, "text", ["k"], bpe_from_json(bpe.to_str())), "input_ids")
    assert got == {i: bpe.encode(v, add_special_tokens=False).ids for i, v in enumerate(values)}


def test_rollup(spark):
    df = spark.createDataFrame([("s", "en", "a b"), ("s", "fr", "c"), ("t", "en", "")], "source string, lang string, text string")
    rows = {(r.source, r.lang): (r.num_rows, r.total_tokens) for r in k.source_rollup(df, "text", ["source", "lang"]).collect()}
    assert rows == {
        ("s", "en"): (1, 2), ("s", "fr"): (1, 1), ("t", "en"): (1, 0),
        ("s", "(all)"): (2, 3), ("t", "(all)"): (1, 0), ("(all)", "(all)"): (3, 3),
    }


def test_query_rows(spark):
    df = texts(spark, ["a b c", "d"])
    assert by_key(k.query_rows(df, "text", 2, ["k"]), "query") == {0: "a b", 1: "d"}
    raw = k.query_rows(df, "text", 2, ["k"], BYTES)
    assert by_key(raw.select("k", F.size("input_ids").alias("n")), "n") == {0: 2, 1: 1}
