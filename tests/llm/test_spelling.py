"""Spelling groups against comparison of all pairs."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import spelling

RNG = random.Random(11)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(docs):
    n = collections.Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def plain_groups(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def random_words(count, letters="abé", shortest=6, longest=11):
    return sorted({"".join(RNG.choice(letters) for _ in range(RNG.randint(shortest, longest))) for _ in range(count)})


@pytest.mark.parametrize("letters, longest", [("ab", 9), ("abcdefg", 7), ("aé", 12)])
def test_banded_rows_find_every_pair(letters, longest):
    words = random_words(250, letters, 2, longest)
    for backwards in (False, True):
        listed = sorted(w[::-1] for w in words) if backwards else words
        shared = np.array([len(w) - len(w) // 2 if backwards else len(w) // 2 for w in listed])
        q, w = spelling.near_words(spelling.SortedWords(listed), listed, shared)
        got = sorted(zip(q.tolist(), w.tolist()))
        expected = [
            (i, j) for i, a in enumerate(listed) for j, b in enumerate(listed) if one_edit(a, b) and a[: shared[i]] == b[: shared[i]]
        ]
        assert got == expected


def test_prefixes_that_may_be_near():
    words = random_words(120, "ab", 2, 6)
    for query, word in itertools.product(words, words):
        if one_edit(query, word) or query == word:
            assert all(spelling._prefix_edits(query, word[:k]) for k in range(len(word) + 1))
    assert not spelling._prefix_edits("abcdef", "xyz")
    assert not spelling._prefix_edits("abc", "abcde")


def corpus():
    base = random_words(60, "abcdefgh") + ["Éclairé", "éclairé", "naïvely", "strasse×", "x" * 3000, "x" * 3001]
    docs = [(None, None), (1, ""), (2, "12 . 34"), (3, " ".join(["short", "words"] * 30))]
    for i in range(120):
        words = [RNG.choice(base[: RNG.randint(2, len(base))]) for _ in range(80)]
        docs.append((i % 50 if i % 7 else None, RNG.choice([" ", "-", "1", "Ā"]).join(w.title() if RNG.random() < 0.2 else w for w in words)))
    for w in base[:20]:
        typo = w[:3] + "z" + w[3:]
        docs += [(7, typo)] * 5 + [(8, typo + "y")] * 5
    # A chain of forms.
    return docs + [(i, " ".join(["hhhhhhh"] * 300 + ["hhhhhhk"] * 40 + ["hhhhhkk"] * 6)) for i in (301, 302)]


def grouped(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"word": F.lit("clash"), "n": F.lit(3), "run": F.lit(0)})
    rows = spelling.group_spellings(df.repartition(4), "doc_id", "text").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_groups_match_all_pairs(spark):
    docs = corpus()
    expected = plain_groups(plain_words(docs))
    assert any(r[1] for r in expected) and any(r[2] != r[1] for r in expected if r[1])
    assert grouped(spark, docs) == expected


def test_many_small_blocks(spark, monkeypatch):
    """Halves that many words share lie over many blocks."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 16)
    monkeypatch.setattr(spelling, "CHUNK", 7)
    words = random_words(400, "ab", 6, 9)
    rows = [(w, RNG.choice([5, 6, 30, 200, 5000])) for w in words]
    forms = spelling.with_roots(spelling.near_forms(spark.createDataFrame(rows, "word string, n bigint"))).collect()
    n = dict(rows)
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in forms} == plain_groups(n)


def test_empty_vocabulary(spark):
    assert grouped(spark, [(None, None), (1, "nothing twice here")]) == set()
    assert spark.createDataFrame([], "doc_id bigint, text string").count() == 0
    assert grouped(spark, []) == set()
