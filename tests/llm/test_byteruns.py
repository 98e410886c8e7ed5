"""Removal of repeated byte strings against counting every string."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import byteruns, suffix

RNG = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(300)] + ["é", "ßü", "日本", "\x00", "a\tb"]


def words(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


def corpus():
    a, b = words(90), words(70)
    rows = [(None, None), (1, ""), (2, "x" * 1000), (3, "x" * 1500 + "y"), (4, "ab" * 900), (5, words(2000))]
    rows += [(5, f"{words(10)} {a} {words(10)}"), (6, a), (7, a), (8, f"{words(30)} {b} {words(4)} {b}"), (None, f"{b} {words(50)}")]
    rows += [(9, "z" * 199), (10, "z" * 200), (11, "q" * 200), (12, "q" * 200), (13, None)]
    rows += [(20 + i, words(RNG.randint(1, 150))) for i in range(30)]
    rows += [(100 + i, f"{words(20)} {a} {words(RNG.randint(0, 30))}") for i in range(30)]
    return rows + [(200 + i, words(3) + a[100:350] + words(3)) for i in range(20)]


DOCS = corpus()


def plain(rows, window):
    times = collections.Counter(x[i : i + window] for x in ((t or "").encode() for _, t in rows) for i in range(len(x) - window + 1))
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - window + 1):
            if times[data[i : i + window]] > 1:
                gone[i : i + window] = True
        spans = [(int(s), int(n)) for s, n in zip(*byteruns._stretches(gone))]
        out.append((key, text, len(data), spans, bytes(c for c, g in zip(data, gone) if not g)))
    return sorted(out, key=repr)


def removed(spark, rows, window=byteruns.WINDOW, parts=3):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"key": F.lit("clash"), "spans": F.lit(0), "t1": F.lit("clash"), "kept": F.lit(1)}
    )
    found = byteruns.remove_byte_runs(df.repartition(parts), "doc_id", "text", window).collect()
    return sorted(((r.key, r.text, r.n_bytes, [(s.place, s.length) for s in r.removed], bytes(r.kept)) for r in found), key=repr)


@pytest.mark.parametrize(
    "window, shard, slice_bytes, gathered, step",
    [(200, 256, 1 << 20, 1 << 23, 1 << 20), (200, 2, 1000, 500, 600), (40, 3, 1 << 20, 1 << 23, 1), (33, 1000, 300, 100, 1 << 20)],
)
def test_matches_counting(spark, monkeypatch, window, shard, slice_bytes, gathered, step):
    """Also with shards split by window, long texts in slices, and rounds of few segments."""
    for name, value in (("SHARD_SEGMENTS", shard), ("SLICE_BYTES", slice_bytes), ("GATHERED_BYTES", gathered), ("STEP_BYTES", step)):
        monkeypatch.setattr(byteruns, name, value)
    assert removed(spark, DOCS, window) == plain(DOCS, window)


@pytest.mark.parametrize("window", [5, 13])
def test_short_windows(spark, window):
    rows = [(i, "".join(RNG.choice("abé") for _ in range(RNG.randint(0, 60)))) for i in range(25)] + [(1, "abab" * 9), (2, None)]
    assert removed(spark, rows, window) == plain(rows, window)


def test_hot_text(spark):
    """A third of all rows are one text; another is its front with a rim of its own."""
    text = words(120)
    rows = [(7, text)] * 60 + [(i, f"{text[:300]}{i}{words(9)}") for i in range(60)] + [(i, words(40)) for i in range(60)]
    assert removed(spark, rows) == plain(rows, byteruns.WINDOW)


def test_empty_table(spark):
    assert removed(spark, []) == []


def text_of(arrays):
    units = np.concatenate([np.append(a, 0) for a in arrays]).astype(np.uint8)
    sizes = np.array([len(a) + 1 for a in arrays])
    starts = np.cumsum(sizes) - sizes
    return units, starts, suffix.dense(np.repeat(np.arange(len(arrays)), sizes) * 256 + units, len(arrays) * 256)


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(1)
    for trial in range(150):
        arrays = [rng.integers(1, rng.integers(2, 5), rng.integers(0, 40)) for _ in range(rng.integers(1, 6))]
        if trial % 3 == 0:
            arrays = [np.tile(a[:3], 10) for a in arrays]
        units, starts, symbols = text_of(arrays)
        order = suffix.suffix_arrays(symbols, starts)
        common, before = suffix.common_prefixes(units, starts, order)
        for array, start in zip(arrays, starts.tolist()):
            text = [*array.tolist(), 0]
            expected = sorted(range(len(text)), key=lambda i: text[i:])
            assert (order[start : start + len(text)] - start).tolist() == expected
            for a, b in zip(expected, expected[1:]):
                n = next(k for k in range(len(text)) if text[a + k] != text[b + k])
                assert (common[start + b], before[start + b]) == (n, start + a)


def test_equal_windows_pick_equal_grams():
    shared = words(80)
    texts = pa.array([words(7) + shared + words(30), words(40) + shared, shared])
    names = collections.defaultdict(set)
    for part in byteruns.segments(texts):
        for row, place, windows, name in zip(part.row.tolist(), part.place.tolist(), part.windows.tolist(), part.name.tolist()):
            data = texts[row].as_py().encode()
            for i in range(place, place + windows):
                names[data[i : i + byteruns.WINDOW]].add(name)
    assert names and all(len(found) == 1 for found in names.values())
