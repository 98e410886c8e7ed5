"""The filter audit against plain loops over orders and rows."""

import collections
import itertools
import re

from pyspark.sql import functions as F

from corpusloom.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id bigint, quality int, toxic int"


def many(*words, n=120):
    return " ".join(w for _ in range(n) for w in words)


DOCS = [
    (1, "copy", "en"), (2, "copy", "de"), (2, "copy", "de"), (None, "copy", "en"), (1, "copy", None),
    (3, None, "en"), (4, "", "en"), (5, " \t\n", None), (6, many("a", "b"), "en"), (7, many("A", "Bc"), ""),
    (8, " ".join(f"w{i}" for i in range(250)), "en"), (9, " ".join(f"w{i}" for i in range(199)) + " $", "en"),
    (10, " ".join(f"w{i}" for i in range(250)), "fr"), (11, "ÀÉ " * 90, "fr"), (12, "x" * 97 + "ABC", "fr"), (13, "x" * 96 + "ABCD", "fr"),
    (14, "one" * 40_000, "en"), (None, None, None), (15, many("b", "a"), "en"), (16, many("a", "b"), "en"),
]
SAID = [(1, 1, 0), (1, 0, 1), (2, None, 1), (6, 1, None), (8, 1, 0), (None, 1, 1), (99, 1, 1), (16, 0, 1), (10, 1, 0)]


def plain(docs, said):
    good = {d for d, q, _ in said if d is not None and q == 1}
    toxic = {d for d, _, t in said if d is not None and t == 1}
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    rows = []
    for d, t, lang in docs:
        t = t or ""
        w = WORD.findall(t)
        failed = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and least[t] < d,
        }
        rows.append((lang or "", {f for f, bad in failed.items() if bad}, d in good, d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        removed_in = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                now = [r for r in left if f in r[1]]
                redundant = sum(f in r[1] for r in gone)
                left = [r for r in left if f not in r[1]]
                gone += now
                removed_in[f] += len(now)
                alone = sum(r[0] == part and r[1] == {f} for r in rows)
                out[part, "".join(order), step] = [len(left), len(now), redundant, alone, sum(r[2] for r in now), sum(r[3] for r in now), f]
        for key, value in out.items():
            if key[0] == part:
                value[-1] = removed_in[value[-1]]
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, docs, said):
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").withColumns(
        {"key": F.lit("clash"), "part": F.lit("clash"), "failed": F.lit(-1), "h1": F.lit("clash")}
    )
    labels = spark.createDataFrame(said, LABELS).withColumn("good", F.lit("clash"))
    found = audit.audit_filters(
        df.repartition(3), labels, "doc_id", "text", F.coalesce("lang", F.lit("")), F.col("quality") == 1, F.col("toxic") == 1
    )
    return {tuple(r[:3]): tuple(r[3:]) for r in found.collect()}


def test_orders_match_plain_loops(spark):
    expected = plain(DOCS, SAID)
    assert audited(spark, DOCS, SAID) == expected
    assert len(expected) == 600 * 4


def test_full_sketch_changes_nothing(spark, monkeypatch):
    """With far more texts than counters every text may repeat, and is compared in full."""
    docs = DOCS + [(100 + i, f"text {i % 300}", "en") for i in range(600)]
    for name in ("MIN_COUNTER_BITS", "MAX_COUNTER_BITS"):
        monkeypatch.setattr(audit, name, 6)
    assert audited(spark, docs, SAID) == plain(docs, SAID)


def test_sketch_clears_unique_texts_only(spark):
    rows = spark.range(3000).select(F.xxhash64(F.col("id") % 2000).alias("h1"), F.xxhash64(F.lit("s"), F.col("id") % 2000).alias("h2"), "id")
    may = audit.possible_repeats(rows, "h1", "h2", audit.counter_bits(3000))
    kept = {r.id for r in rows.where(may("h1", "h2")).collect()}
    assert {i for i in range(3000) if i < 1000 or i >= 2000} <= kept
    assert len(kept) < 2200


def test_hot_key_and_text(spark):
    """A third of all rows with one key and one text."""
    docs = [(5, "same", "en")] * 200 + [(i, f"t {i}", "en") for i in range(300)] + [(6, "same", "en")] * 100
    assert audited(spark, docs, SAID) == plain(docs, SAID)


def test_empty_tables(spark):
    assert audited(spark, [], SAID) == {}
    assert audited(spark, DOCS, []) == plain(DOCS, [])
