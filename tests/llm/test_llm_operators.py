"""The dealt operators against brute force on small fixtures with nulls, ties, repeats and clashing names."""

import collections
import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from corpusloom.llm import chat, forest, hashing, jaccard, language, mixing, packing, quality, queries, repeats, threshold, warc
from corpusloom.llm.encode import WordEncoder
from corpusloom.llm.words import text_slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = np.random.default_rng(3)
VOCABULARY = [f"w{i}" for i in range(400)]


def words(n):
    return [VOCABULARY[i] for i in RNG.integers(0, 400, n)]


def corpus():
    """Null, empty, blank, short, long, equal and near equal texts, with passages that several share."""
    passage, base = words(60), words(80)
    texts = [None, "", " \n\t ", "one", "one", "a b c d", " ".join(base), " ".join(base), " ".join(words(3000))]
    near = list(base)
    near[5] = "other"
    texts += [" ".join(near), " ".join(words(30) + passage + words(20)), " ".join(passage), " ".join(words(9) + passage[7:40])]
    texts += ["x " * 50, "x " * 30 + "y", "a b " * 30, "a b " * 12 + " ".join(words(5))]
    texts += [" ".join(words(int(n))) for n in RNG.integers(1, 90, 20)]
    return list(enumerate(texts))


CORPUS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, -1, "clash") for i, t in CORPUS]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, size string"
    ).repartition(3)


def test_sql_of_llm_queries(spark, sf):
    duck = connect(sf)
    for name, sql in queries.R.oracles.items():
        assert difference(queries.R.queries[name](spark, sf).toArrow(), duck.sql(sql).to_arrow_table()) is None, name


def test_packing_places_every_id_once(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    limits = packing.Limits(64, 5, 48)
    rows = packing.pack_documents(docs, "doc_id", "text", queries.tokenizer_file(), 2, limits).collect()
    parts, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in CORPUS:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        got = b"".join(bytes(p.ids) for p in sorted(parts[i], key=lambda p: p.start))
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert {p.example_tokens for p in parts[i]} == {len(ids)}
    for pieces in sequences.values():
        pieces.sort(key=lambda p: p.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        total = sum(p.length for p in pieces)
        assert total <= 48 and len(pieces) <= 5


def test_packing_whole_examples(spark):
    rows = [(i, list(range(n)), [k % 2 for k in range(n)]) for i, n in enumerate(RNG.integers(0, 40, 200).tolist())]
    rows.append((None, None, None))
    df = spark.createDataFrame(rows, "k bigint, ids array<int>, mask array<int>")
    packed = packing.pack_examples(df, "k", "ids", "mask", packing.Limits(50, 4, 22)).collect()
    assert len(packed) == len(rows)
    by = collections.defaultdict(list)
    for p in packed:
        by[p.sequence_id].append(p)
    for pieces in by.values():
        assert sum(p.length for p in pieces) <= 50 and len(pieces) <= 4
        assert sum(p.length // 2 for p in pieces) <= 22
    with pytest.raises(Exception, match="beyond"):
        packing.pack_examples(df, "k", "ids", None, packing.Limits(20, 4, 20)).collect()


def test_archives_round_trip(spark, tmp_path):
    page = "x" * 150
    rows = [(3, "u3", page), (1, None, page), (2, "u\r\nX: 2", "é" * 60), (5, "u", None), (6, "u", "short"), (7, "u", "short"), (None, "u", page)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    index = warc.archive_pages(df, "page_id", "url", "html", f"file://{tmp_path}/a")
    found = {r.page: r for r in warc.read_back(index, f"file://{tmp_path}/a/records").collect()}
    assert {p: (r.record_type, r.refers_to) for p, r in found.items()} == {
        "1": ("response", None), "3": ("revisit", "1"), "2": ("response", None), "5": ("response", None),
        "6": ("response", None), "7": ("response", None), "None": ("revisit", "1"),
    }
    assert bytes(found["2"].payload) == ("é" * 60).encode() and found["3"].payload_bytes == 150
    assert found["3"].payload_digest == hashlib.sha256(page.encode()).hexdigest()
    for name in {r.path for r in index.collect()}:
        whole = open(f"{tmp_path}/a/records/{name}", "rb").read()
        assert b"".join(warc.inflate(__import__("io").BytesIO(whole))).startswith(b"WARC/1.1\r\n")
    assert warc.archive_pages(df.limit(0), "page_id", "url", "html", f"file://{tmp_path}/b").count() == 0


def test_repeats_against_all_windows(docs):
    known = {i: WORD.findall(t or "") for i, t in CORPUS}
    first = {}
    for i, w in known.items():
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    for r in repeats.remove_repeats(docs, "doc_id", "text", carry=("size",)).collect():
        w = known[r.key]
        gone = {k for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < r.key for k in range(j, j + 13)}
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept == " ".join(x for k, x in enumerate(w) if k not in gone) and r.rest["size"] == "clash"


def test_repeats_with_null_and_repeated_keys(spark):
    text = " ".join(words(20))
    df = spark.createDataFrame([(None, text), (4, text), (4, text), (4, "p q"), (9, text)], "k bigint, t string")
    got = sorted((-1 if r.key is None else r.key, r.n_words, r.n_removed) for r in repeats.remove_repeats(df, "k", "t").collect())
    assert got == [(-1, 20, 0), (4, 2, 0), (4, 20, 0), (4, 20, 0), (9, 20, 20)]
    assert repeats.remove_repeats(df.limit(0), "k", "t").count() == 0


def test_similar_texts_against_all_pairs(docs):
    sets = {}
    for i, t in CORPUS:
        w = WORD.findall(t or "")
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    links, root = collections.Counter(), {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_duplicates(docs, "doc_id", "text").collect()}
    assert got == {i: (root[i], links[i]) for i in sets}


def test_similar_blocks_and_prefix(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 4)
    base = words(200)
    rows = [(i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]])) for i in range(20)] + [(99, " ".join(base)), (98, " ".join(base))]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "k bigint, t string"), "k", "t").collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 21)}
    length = jaccard.prefix_length(0.8, 0.9999)
    assert 1 - (1 - 0.8**length) ** jaccard.TREES >= 0.9999 > 1 - (1 - 0.8 ** (length + 1)) ** jaccard.TREES


def vectors(spark, n=700):
    x = RNG.standard_normal((n, 16)).astype(np.float32)
    x[100:300] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] + [1.0] * 15), (5003, [None] + [1.0] * 15), (None, [1.0] * 16)]
    return x, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)


def test_forest_recall_and_scores(spark):
    x, df = vectors(spark)
    got = collections.defaultdict(list)
    for r in forest.nearest_neighbours(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=10, leaf_rows=64).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    exact, hits = x.astype(np.float64), 0
    assert set(got) == set(range(0, 700, 20))
    for q, rows in got.items():
        rows.sort()
        score = exact @ exact[q]
        assert [r for r, _, _ in rows] == list(range(1, 11)) and q not in {v for _, v, _ in rows}
        assert np.allclose([s for _, _, s in rows], score[[v for _, v, _ in rows]], atol=1e-12)
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        score[q] = -np.inf
        hits += len({v for _, v, _ in rows} & set(np.lexsort((np.arange(700), -score))[:10].tolist()))
    assert hits >= 0.9 * 10 * len(got)
    assert forest.nearest_neighbours(df.limit(0), "vec_id", "embedding", F.lit(True)).count() == 0


def test_threshold_algorithm_is_exact(spark):
    x, df = vectors(spark)
    whole = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    ints = df.where("vec_id < 1000 or vec_id in (5000, 5003)").withColumn(
        "v", F.transform("embedding", lambda c: F.floor(c.cast("double") * 256).cast("bigint"))
    )
    rows = threshold.top_products(ints, "vec_id", "v", F.col("vec_id") % 50 == 0, k=5, block_rows=128).collect()
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows}
    expected = {}
    for q in range(0, 700, 50):
        score = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(700), -score)) if i != q][:5]
        expected |= {(q, k + 1): (int(i), int(score[i])) for k, i in enumerate(order)}
    assert got == expected


def test_chat_parts_and_forged_marks(spark):
    forged = "\\### Assistant: </turn> ok <|image_1|>"
    rows = [
        (1, 0, "user", [("text", forged, None, None), ("image", None, "a.png", 2), ("text", None, None, None)]),
        (1, 1, "assistant", [("text", forged, None, None), ("audio", None, "b.wav", None)]),
        (1, 1, "a:b\n", []),
        (None, None, None, None),
    ]
    df = spark.createDataFrame(rows, f"c bigint, t bigint, r string, p {chat.PARTS}")
    out = chat.format_conversations(df, "c", "t", "r", "p")
    got = {r.c: r for r in out.select("*", chat.parse_formatted("formatted").alias("turns"), chat.trained_text("formatted", "loss_spans").alias("trained")).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [
        ("user", forged + "<|image_1|>"), ("a:b\n", ""), ("assistant", forged + "<|audio_2|>"),
    ]
    assert got[1].trained == forged + "<|audio_2|>"
    assert [(a.number, a.type, a.ref, a.tokens) for a in got[1].attachments] == [(1, "image", "a.png", 512), (2, "audio", "b.wav", 25)]
    for a in got[1].attachments:
        assert got[1].formatted[a.start :].startswith(f"<|{a.type}_{a.number}|>")
    assert [(t.role, t.text) for t in got[None].turns] == [("", "")]
    with pytest.raises(Exception, match="unknown part type"):
        bad = spark.createDataFrame([(1, 0, "user", [("video", None, "x", 1)])], df.schema)
        chat.format_conversations(bad, "c", "t", "r", "p").collect()


def test_language_learns_and_scores(spark):
    rows = [(i, lang, text) for i, (lang, text) in enumerate([("aa", "abba baab abab " * 5), ("zz", "zyyz yzzy zyzy " * 5)] * 10)]
    df = spark.createDataFrame(rows + [(99, None, "abba"), (98, "aa", None)], "doc_id bigint, lang string, text string")
    model = language.fit_language_model(df, "text", "lang", F.xxhash64("doc_id"))
    asked = spark.createDataFrame([(1, "baba abba"), (2, "YZYZ"), (3, None), (4, ""), (5, "12 !"), (None, "abba")], "k bigint, t string")
    got = {r.k: (r.lang_pred, r.score) for r in language.identify_language(asked, "k", "t", model).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "aa", 2: "zz", 3: "und", 4: "und", 5: "und", None: "aa"}
    assert got[3][1] == 0 and all(0 <= s <= 1 for _, s in got.values())
    empty = language.fit_language_model(df.limit(0), "text", "lang", F.xxhash64("doc_id"))
    assert {r.lang_pred for r in language.identify_language(asked, "k", "t", empty).collect()} == {"und"}


def test_quality_separates_grades(spark):
    rows, ratings = [], []
    for i in range(900):
        grade = i % 3
        text = " ".join(words(40) + (["junk"] if grade == 0 else ["rude"] if grade == 1 else []))
        rows.append((i, text, "clash"))
        if i < 600:
            ratings.append((i, grade))
    rows += [(9000, None, ""), (9001, " ", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality string")
    rated = spark.createDataFrame([*ratings, (None, 1), (5, None)], "doc_id bigint, grade int")
    model = quality.fit_quality_model(docs, rated, "doc_id", "text", "grade", 3)
    assert model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r.quality for r in quality.score_quality(docs, "text", model).collect()}
    held_out = [(i, got[i]) for i in range(600, 900)]
    assert np.mean([q.keep == (i % 3 == 2) for i, q in held_out]) > 0.95
    assert not got[9000].keep and not got[9001].keep
    none = quality.fit_quality_model(docs, rated.limit(0), "doc_id", "text", "grade", 3)
    assert all(r.quality.keep for r in quality.score_quality(docs.where("doc_id < 50"), "text", none).collect())


def test_mixture_near_targets_and_repeats(spark, docs):
    rows = mixing.sized_rows(docs, "doc_id", "text", "source").cache()
    mixed = mixing.apply_mixture(rows, mixing.mixture_plan(rows)).collect()
    by = collections.defaultdict(list)
    for r in mixed:
        by[r.source].append(r)
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
    assert len(mixed) == len(CORPUS)
    for group in by.values():
        assert abs(sum(r.taken for r in group) - group[0].target) <= max(r["size"] for r in group)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(WORD.findall(r.text or "")) for r in out.collect()) == sum(r.taken for r in mixed)
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path, docs):
    import corpus_pipeline as pipeline

    sf = str(tmp_path)
    spark.createDataFrame([(i, 1, 0) for i, _ in CORPUS], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs.drop("size").write.parquet(f"{sf}/documents.parquet")
    table = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, table, sf)
        assert after.columns == table.columns
        assert stage(spark, table.limit(0), sf).count() == 0
        table = spark.createDataFrame(after.collect(), table.schema)
    kept = {i for i, t in CORPUS if WORD.findall(t or "")} - {4, 7, 9}
    assert {r.doc_id for r in table.collect()} <= kept
    pieces = pipeline.run(spark, sf).collect()
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(pieces[0].asDict())


def test_crc_of_pieces(docs):
    pieces = packing.pack_documents(docs, "doc_id", "text", queries.tokenizer_file(), 2)
    plain = {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in pieces.collect()}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in packing.with_crc32(pieces).collect()} == plain


def near_copies_dropped(rows):
    """Plain version of the near-duplicate stage: of each group the smallest id stays, null ids last."""
    rows = list({(i, t): (i, t) for i, t in rows}.values())
    sets = []
    for _, text in rows:
        found = WORD.findall(text or "")
        sets.append({tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    groups = collections.defaultdict(list)
    for row, g in zip(rows, group):
        groups[g].append(row)
    return [sorted((i is None, i or 0) for i, _ in g)[0] for g in groups.values()], groups


def test_near_duplicate_stage_judges_rows(spark):
    import corpus_pipeline as pipeline

    base, hot, lone = words(100), words(90), words(70)
    near = [*base[:50], "other", *base[51:]]
    rows = [(3, " ".join(base)), (5, " ".join(near)), (5, " ".join(lone)), (5, " ".join(words(60)))]
    rows += [(7, " ".join(hot)), (7, " ".join([*hot[:-1], "end"])), (7, " ".join(words(50)))]
    rows += [(None, " ".join(words(40))), (None, " ".join(words(40)))]
    keyless = words(120)
    rows += [(None, " ".join(keyless)), (None, " ".join([*keyless[:-1], "end"])), (None, " ".join(base))]
    rows += [(9, "same same"), (9, "same same"), (None, None), (8, None), (8, ""), (2, "a  b"), (2, "a b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, docs, "").collect()]
    firsts, groups = near_copies_dropped(rows)
    # One row of each group, with the group's smallest id; which of equal ids goes by a hash.
    name = {row: g for g, members in groups.items() for row in members}
    assert sorted(name[r] for r in got) == sorted(groups)
    assert collections.Counter((i is None, i or 0) for i, _ in got) == collections.Counter(firsts)
    assert (5, " ".join(lone)) in got and (5, " ".join(near)) not in got and (None, " ".join(base)) not in got


def test_texts_under_one_key_meet_their_own_class(spark, monkeypatch):
    """Candidate classes that share a key get their texts back row by row, not every text of the key."""
    read = []
    kept = type(spark.range(1)).mapInArrow

    def counted(df, function, schema, *more):
        if "w_node" in str(schema):
            read.append(df.count())
        return kept(df, function, schema, *more)

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", counted)
    rows = []
    for k in range(20):
        base = words(60)
        rows += [(None, " ".join(base)), (None, " ".join([*base[:-1], f"new{k}"])), (None, " ".join(base))]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "k bigint, t string"), "k", "t").collect()
    assert [(r.class_id, r.n_links) for r in got] == [(None, 2)] * 60
    assert read == [40]


def test_repeated_vector_keys_are_spread(spark, monkeypatch):
    """Blocks stay near their size where one key has all rows; no list holds a query's hits."""
    sizes, kept = [], threshold.stage

    def counted(df, name):
        table = kept(df, name)
        if name == "blocks":
            sizes.extend(r[0] for r in table.select(F.size("ids")).collect())
        return table

    monkeypatch.setattr(threshold, "stage", counted)
    x = RNG.standard_normal((3000, 8)).astype(np.float32)
    rows = [(7, v.tolist()) for v in x] + [(i, v.tolist()) for i, v in enumerate(x[:3], 100)]
    df = spark.createDataFrame(rows, "k bigint, v array<float>").repartition(2)
    ints = df.withColumn("v", F.transform("v", lambda c: F.floor(c.cast("double") * 256).cast("bigint")))
    found = threshold.top_products(ints, "k", "v", F.col("k") >= 100, k=5, block_rows=64)
    got = collections.defaultdict(list)
    for r in found.collect():
        got[r.query_id].append((-r.score, r.vec_id))
    whole = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    for q in range(3):
        every = [(-int(s), 7) for s in whole @ whole[q]] + [(-int(whole[i] @ whole[q]), 100 + i) for i in range(3) if i != q]
        assert sorted(got[100 + q]) == sorted(every)[:5]
    assert len(sizes) == 47 and max(sizes) < 2 * 64
    near = forest.nearest_neighbours(df, "k", "v", F.col("k") >= 100, k=5, leaf_rows=64)
    for plan in (t._jdf.queryExecution().executedPlan().toString() for t in (near, found)):
        assert "WindowGroupLimit" in plan and "collect_set" not in plan


def test_samples_are_never_empty(spark):
    """A bound far below one row in the hash range, as a huge table has, still leaves something to learn from."""
    x, df = vectors(spark, 400)
    near = forest.nearest_neighbours(df, "vec_id", "embedding", F.col("vec_id") == 1, k=3, leaf_rows=64, sample_rows=0)
    assert near.count() == 3
    every = spark.range(0, 1 << 12).select(F.col("id").alias("doc_id"), F.lit("some junk").alias("text"))
    rated = every.select("doc_id", F.lit(0).alias("grade"))
    model = quality.fit_quality_model(every, rated, "doc_id", "text", "grade", 3, max_fit_rows=0)
    assert np.isfinite(model.thresholds).all()
    assert hashing.sample_share(1 << 50, 10_000, 5) > 5 and hashing.sample_share(10, 10, 3) == hashing.SAMPLE_RANGE


def test_rare_languages_are_learned(spark):
    rows = [(i, "aa" if i % 500 else "zz", "abba baab" if i % 500 else "zyyz yzzy") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = language.fit_language_model(df, "text", "lang", F.xxhash64("doc_id"), max_fit_rows=40)
    assert model.languages == ["aa", "zz"]
    assert np.allclose(np.exp(model.log_priors), [3993 / 4002, 9 / 4002])
    asked = spark.createDataFrame([(1, "baab abba"), (2, "yzzy zyyz")], "k bigint, t string")
    assert {r.k: r.lang_pred for r in language.identify_language(asked, "k", "t", model).collect()} == {1: "aa", 2: "zz"}
    none = language.fit_language_model(df, "text", "lang", F.xxhash64("doc_id"), max_fit_rows=0)
    assert none.languages == ["aa", "zz"] and np.ptp(none.log_probs[:, 1]) > 0
    assert [language._quota(c, 100) for c in ([10, 20], [10, 200], [60, 70, 5])] == [20, 90, 47]


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_quality(spark, rows, ratings):
    """The model is the operator's; each row is judged on its own."""
    import pyarrow as pa

    table = spark.createDataFrame(rows, COLUMNS)
    model = quality.fit_quality_model(table, queries.graded(ratings), "doc_id", "text", "grade", 3)
    kept = []
    for row in rows:
        _, features, n_words = quality.text_features(pa.array([row[1]], pa.string()))
        top = model.probabilities(np.array([model.weights[features].sum()]))[0, -1]
        if n_words[0] and top >= 0.5:
            kept.append(row)
    return kept


def plain_near_duplicates(spark, rows):
    names = {r.t: r.h for r in spark.createDataFrame([(t,) for t in {r[1] for r in rows}], "t string").selectExpr("t", "xxhash64(t) h").collect()}
    _, groups = near_copies_dropped([r[:2] for r in rows])
    whole = {r[:2]: r for r in rows}
    return [whole[min(g, key=lambda r: (r[0] is None, r[0] or 0, names[r[1]]))] for g in groups.values()]


def plain_repeats(rows):
    def windows(row):
        w = WORD.findall(row[1] or "")
        return w, [tuple(w[j : j + 13]) for j in range(len(w) - 12)]

    first = {}
    for row in rows:
        for window in windows(row)[1] if row[0] is not None else []:
            first[window] = min(first.get(window, row[0]), row[0])
    out = []
    for row in rows:
        w, found = windows(row)
        gone = {k for j, x in enumerate(found) if row[0] is not None and first[x] < row[0] for k in range(j, j + 13)}
        text = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((row[0], text, *row[2:4], len(text)) if gone else row)
    return out


def plain_mixture(rows):
    def md5(x):
        return "-" if x is None else hashlib.md5(str(x).encode()).hexdigest()

    size = {r: len(WORD.findall(r[1] or "")) for r in rows}
    h = {r: int(hashlib.md5((md5(r[0]) + md5(r[1])).encode()).hexdigest()[:15], 16) for r in rows}
    total = collections.Counter()
    for r in rows:
        total[r[3]] += size[r]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        level = (sum(total.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * total[s] < level * weight[s]}
        target |= {s: 3 * total[s] for s in full} if full else {s: level * weight[s] for s in open_}
        open_ -= full or set(open_)
    out = []
    for s in order:
        mine = sorted((r for r in rows if r[3] == s), key=h.get)
        times = int(target[s] // total[s]) if total[s] else 0
        rest, upto, cut = target[s] - times * total[s], 0, 0
        for x in sorted({h[r] for r in mine if size[r]}):
            step = sum(size[r] for r in mine if h[r] == x)
            if upto + step > rest:
                cut = x + (rest * 2 > upto * 2 + step)
                break
            upto += step
        for r in mine:
            out += [r] * (times + (h[r] < cut))
    return out


def packed_places(pieces, rows):
    """Where each token of ``rows`` stands in ``pieces``, checked: (key, position) as often as rows have it."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    texts, expected, got = collections.defaultdict(list), collections.Counter(), collections.Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, queries.END_ID], dtype="<u4")
        texts[r[0]].append(ids)
        expected.update((r[0], len(ids), k, int(x)) for k, x in enumerate(ids))
    for p in pieces:
        parts = [t[p.start : p.start + p.length] for t in texts[p.doc_id] if len(t) == p.doc_tokens]
        part = next(t for t in parts if zlib.crc32(t.tobytes()) == p.ids_crc32)
        got.update((p.doc_id, p.doc_tokens, p.start + k, int(x)) for k, x in enumerate(part))
    assert got == expected


def test_pipeline_rows_against_plain_stages(spark, tmp_path):
    import corpus_pipeline as pipeline

    sf, rows, grades = str(tmp_path), [], []
    passage, base = words(40), words(80)
    for i in range(300):
        grade = i % 3
        mark = (["junk"] * 3, ["rude"] * 3, [])[grade]
        rows.append((i, " ".join(words(30) + mark), "en", f"s{i % 4}" if i % 7 else None, -1))
        grades.append((i, int(grade > 0), int(grade == 1)))
    near = [*base[:-1], "end"]
    texts = [(1000, base), (1001, near), (1001, words(50)), (1002, passage), (1003, words(9) + passage + words(9)), (1003, words(20))]
    texts += [(1004, words(8) + passage[:30]), (None, base), (None, words(30) + passage), (1005, passage[3:35] + ["junk"])]
    keyless = words(70)
    texts += [(None, keyless), (None, [*keyless[:-1], "end"]), (1006, ["short"]), (1006, ["short"]), (1007, ["short"])]
    rows += [(i, " ".join(w), "en", "s1", len(w)) for i, w in texts]
    rows += [(1008, None, "en", "s2", None), (None, None, "en", None, None), (1009, "", "en", "s2", 0), (1001, " \n", "en", "s0", 2)]
    ratings = spark.createDataFrame(grades, "doc_id bigint, quality int, toxic int")
    ratings.write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{sf}/documents.parquet")
    plain = {
        "quality": lambda r: plain_quality(spark, r, ratings),
        "near_duplicates": lambda r: plain_near_duplicates(spark, r),
        "repeats": plain_repeats,
        "mixture": plain_mixture,
    }
    # Each stage is given the rows that the first drops, too.
    for name, stage in pipeline.STAGES[1:-1]:
        got = stage(spark, spark.createDataFrame(rows, COLUMNS), sf).collect()
        assert collections.Counter(map(tuple, got)) == collections.Counter(plain[name](rows)), name
    kept = rows
    for name, stage in pipeline.STAGES[:-1]:
        got = stage(spark, spark.createDataFrame(kept, COLUMNS), sf).collect()
        kept = plain[name](kept)
        assert collections.Counter(map(tuple, got)) == collections.Counter(kept), name
    assert 80 < len(set(kept)) < 150 and any(r[0] is None for r in kept)
    packed_places(pipeline.run(spark, sf).collect(), kept)


def test_queries_copied_to_blocks_are_not_broadcast(spark):
    """Their file is small, the copies for all blocks of candidates are not: they are shuffled."""
    rows = [(i, [i % 7, i % 5, 1]) for i in range(400)]
    df = spark.createDataFrame(rows, "k bigint, v array<bigint>")
    found = threshold.top_products(df, "k", "v", F.col("k") < 2, k=3, block_rows=8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    got = sorted(map(tuple, found.collect()))
    want = []
    for q in range(2):
        scores = sorted((-sum(a * b for a, b in zip(rows[q][1], v)), i) for i, v in rows if i != q)
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:3], 1)]
    assert got == want


def test_copies_for_salts_and_bands_are_not_broadcast(spark, monkeypatch):
    """An exploded table is sized as before it: the copies of classes for salts, and bands of texts, are shuffled."""
    plans, kept = [], jaccard.components

    def planned(members, *names):
        plans.append(members._jdf.queryExecution().executedPlan().toString())
        return kept(members, *names)

    monkeypatch.setattr(jaccard, "components", planned)
    base = [words(60) for _ in range(5)]
    rows = [(i, " ".join([*base[i % 5][:-1], f"new{i}"])) for i in range(20)] + [(20, "alone"), (21, None), (None, "alone")]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "k bigint, t string"), "k", "t")
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    for plan in (plans[0], plans[-1]):
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    got = {(r.k, r.class_id, r.n_links) for r in found.collect()}
    want = {(i, i % 5, 3) for i in range(20)} | {(20, 20, 1), (21, 21, 0), (None, 20, 1)}
    assert got == want


def test_ids_are_made_in_little_memory():
    """What a worker holds beside a batch of 9 MB of text; slices of 8 MB took 67 MB here."""
    encode = WordEncoder(queries.tokenizer_file())
    batch = pa.RecordBatch.from_pydict({"text": ["word and " * 1000] * 1000})
    encode.encode(batch.column(0)[:1], queries.END_ID)
    tracemalloc.start()
    try:
        made = sum(len(encode.encode(part.column(0), queries.END_ID)[1]) for part in text_slices(batch, "text"))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert made == 2001 * 1000
    assert most < 30e6
