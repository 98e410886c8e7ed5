"""Fitted models against the same sums written out by hand, and the edges of the vector search."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import forest, jaccard, language, quality

RNG = np.random.default_rng(17)
WORDS = ["the", "Cat", "sat,", "ON", "mat.", "über", "Straße", "naïve", "junk", "junk!", "buy", "now", "...", "été"]
TEXTS = [" ".join(RNG.choice(WORDS, int(n))) for n in RNG.integers(1, 30, 120)] + [None, "", " \n", "12 34", "ñandú", "junk junk junk"]


def hashed_trigrams(text):
    """Buckets of all trigrams of a text: lower case, what is no letter a blank, blanks before and after."""
    letters = [" ", " ", *(c if c.isalpha() else " " for c in (text or "").lower()), " ", " ", " "]
    out = []
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        h = (ord(a) * 0x9E3779B1) % 2**32 ^ (ord(b) * 0x85EBCA6B) % 2**32
        h = ((h ^ (h >> 15)) + ord(c) * 0xC2B2AE35) % 2**32
        out.append((h * 0x27D4EB2F) % 2**32 >> (32 - language.BUCKET_BITS))
    return out


def test_naive_bayes_by_hand(spark):
    rows = [(i, t, ["en", "de", None, "fr"][i % 4]) for i, t in enumerate(TEXTS)] + [(None, "Cat Cat", "de")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    model = language.fit_language_model(df.repartition(3), "text", "lang", F.xxhash64("doc_id"))
    counts, priors = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        if lang:
            counts[lang].update(hashed_trigrams(text))
            priors[lang] += 1
    names = sorted(counts)
    sizes = {k: sum(counts[k].values()) + 0.5 * language.BUCKETS for k in names}
    found = {r.doc_id: r for r in language.identify_language(df.where("doc_id is not null"), "doc_id", "text", model).collect()}
    for key, text, _ in rows[:-1]:
        if not any(c.isalpha() for c in text or ""):
            assert (found[key].lang_pred, found[key].score) == ("und", 0.0)
            continue
        total = {
            k: math.log((priors[k] + 1) / (sum(priors.values()) + len(names)))
            + sum(math.log((counts[k][b] + 0.5) / sizes[k]) for b in hashed_trigrams(text))
            for k in names
        }
        best = max(names, key=lambda k: total[k])
        share = 1 / sum(math.exp(v - total[best]) for v in total.values())
        assert found[key].score == pytest.approx(share, abs=1e-3)
        assert found[key].lang_pred == best or share < 0.51


def word_names(word):
    core = re.sub(r"^[\W_]+|[\W_]+$", "", word)
    case = "U" if core.isupper() and len(core) > 1 else "T" if core.istitle() else "l"
    marks = word.replace(core, "w", 1) if core else word[:3]
    low = core.lower()
    return [low, "\0" + low[:4], "\0" + low[:5], "\0\0" + case + marks[:6]]


def features_of(text):
    """The hashed features of a text: its words, their first letters and shapes, and the tenth of repeated words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return set(), 0
    again = sum(a == b for a, b in zip(words, words[1:])) * 10 // len(words)
    names = {n for w in words for n in word_names(w)} | {f"\0\0\0{again}"}
    return {zlib.crc32(n.encode()) & (quality.FEATURES - 1) for n in names}, len(words)


def test_trigrams_of_a_text_are_its_own():
    """Whatever stands beside it, a text has the same trigrams."""
    for text in TEXTS:
        buckets, starts, _ = language.trigram_buckets([text, "xyz"])
        alone, _, _ = language.trigram_buckets([text])
        assert buckets[: starts[1]].tolist() == alone.tolist() == hashed_trigrams(text)


def test_features_and_scores_by_hand(spark):
    weights = np.where(RNG.random(quality.FEATURES) < 0.5, RNG.normal(size=quality.FEATURES), 0)
    model = quality.QualityModel(weights, np.array([-1.0, 0.5]))
    rows, features, words = quality.text_features(pa.array(TEXTS, pa.string()))
    got = collections.defaultdict(set)
    for r, f in zip(rows.tolist(), features.tolist()):
        got[r].add(f)
    for i, text in enumerate(TEXTS):
        assert (got[i], words[i]) == features_of(text)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k int, text string").withColumn("quality", F.lit("clash"))
    for r in quality.score_quality(df.repartition(3), "text", model).collect():
        own, n = features_of(r.text)
        score = sum(weights[f] for f in own)
        above = [1 / (1 + math.exp(t - score)) if n else 0.0 for t in (-1.0, 0.5)]
        assert r.quality.expected_grade == pytest.approx(sum(above)) and r.quality.p_top == pytest.approx(above[1])
        assert r.quality.keep == (above[1] >= 0.5)


def loss_of(model, rows, features, grades, decay=1e-6):
    """The penalized negative log-likelihood of graded rows, one row at a time."""
    score = collections.defaultdict(float)
    for r, f in zip(rows.tolist(), features.tolist()):
        score[r] += model.weights[f]
    total = 0.0
    for i, g in enumerate(grades.tolist()):
        above = [1.0, *(1 / (1 + math.exp(t - score[i])) for t in model.thresholds), 0.0]
        total -= math.log(max(above[g] - above[g + 1], 1e-12))
    return total / len(grades) + decay / 2 * float((model.weights**2).sum())


def test_ordinal_fit_is_an_optimum():
    """No weight and no threshold can be moved to a better likelihood than the fit's by more than a little."""
    n = 400
    signal = RNG.integers(0, 2, (n, 6))
    score = signal @ np.array([3.0, -2.5, 2.0, 0.0, 1.5, -1.0]) + RNG.logistic(size=n)
    grades = np.digitize(score, [-0.5, 2.0])
    rows, features = np.nonzero(signal)
    model = quality.fit_ordinal(rows, features, grades, 3, steps=1500, rate=0.05, decay=1e-4, least_score=0.0, least_effect=0.0)
    assert model.thresholds[0] < model.thresholds[1]
    best = loss_of(model, rows, features, grades, 1e-4)
    for step in (0.05, -0.05):
        for f in range(6):
            moved = model.weights.copy()
            moved[f] += step
            assert loss_of(quality.QualityModel(moved, model.thresholds), rows, features, grades, 1e-4) > best - 1e-5
        for k in range(2):
            moved = model.thresholds.copy()
            moved[k] += step
            assert loss_of(quality.QualityModel(model.weights, moved), rows, features, grades, 1e-4) > best - 1e-5


def test_doubles_are_scored_as_given(spark):
    x = RNG.normal(size=(60, 4)) * 1e3 + 1e-9
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>").withColumn("score", F.lit("clash"))
    found = forest.nearest_neighbours(df.repartition(3), "id", "v", F.col("id") < 10, k=59, leaf_rows=1000).collect()
    # Nearly all of them: leaves are opened up to the recall asked for.
    assert len(found) >= 0.9 * 10 * 59
    for r in found:
        total = 0.0
        for a, b in zip(x[r.query_id].tolist(), x[r.vec_id].tolist()):
            total += a * b
        assert r.score == total


def test_hits_of_a_task_are_cut_to_k(spark, monkeypatch):
    """Whatever a task may hold, the neighbours are the same."""
    x = RNG.normal(size=(300, 5)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<float>")
    seen = []
    for held, values in ((1 << 20, 1 << 20), (50, 100)):
        monkeypatch.setattr(forest, "HELD_HITS", held)
        monkeypatch.setattr(forest, "CHUNK_VALUES", values)
        seen.append(sorted(forest.nearest_neighbours(df, "id", "v", F.col("id") % 10 == 0, k=7, leaf_rows=32).collect()))
    assert seen[0] == seen[1] and len(seen[0]) == 30 * 7


def test_lengths_and_keys_are_checked(spark):
    uneven = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id bigint, v array<float>")
    with pytest.raises(ValueError, match="one length"):
        forest.nearest_neighbours(uneven, "id", "v", F.lit(True))
    with pytest.raises(TypeError, match="whole numbers"):
        forest.nearest_neighbours(uneven.withColumn("id", F.lit("a")), "id", "v", F.lit(True))


def test_names_of_long_orders_differ():
    """Two words in the order whose sums of powers agree with those of its reverse roles, from 1,024 places on."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    texts = [" ".join("ab"[b] for b in bits), " ".join("ba"[b] for b in bits), "", None, "a b", "a b", "b a"]
    names = jaccard._nodes(pa.array(texts, pa.string())).to_pylist()
    assert names[2] is None and names[3] is None and names[4] == names[5]
    assert len({names[0], names[1], names[4], names[6]}) == 4


def test_ratings_and_rows_of_one_key_are_bounded(spark):
    """A key with a third of all ratings and rows is learned from like any other."""
    rows = [(7, f"junk number {i}") for i in range(400)] + [(i, f"fine text {i % 9}") for i in range(1000, 1800)]
    docs = spark.createDataFrame(rows + [(7, "junk number 1")] * 50, "doc_id bigint, text string")
    rated = spark.createDataFrame([(7, 0)] * 900 + [(i, 2) for i in range(1000, 1800)] + [(None, 1)], "doc_id bigint, grade int")
    model = quality.fit_quality_model(docs, rated, "doc_id", "text", "grade", 3, max_fit_rows=100)
    kept = {r.text.split()[0] for r in quality.score_quality(docs, "text", model).where("quality.keep").collect()}
    assert np.isfinite(model.thresholds).all() and "fine" in kept
    whole = quality.fit_quality_model(docs, rated, "doc_id", "text", "grade", 3)
    assert {r.text.split()[0] for r in quality.score_quality(docs, "text", whole).where("quality.keep").collect()} == {"fine"}
