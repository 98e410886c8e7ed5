"""Grouping of spelling variants by a dynamic program over sorted vocabularies (operator 11).

The vocabulary is sorted and cut into blocks of neighbouring words, once as written and once reversed. The
edit matrix of a query word against a list word has a row for each code point of the list word. In a
sorted list, words with a common prefix are neighbours, and their rows over that prefix are the same: a row
is worked out once for each range of words that the adjacent LCPs join, and handed on to the ranges inside
it. A band of three cells is all that one edit can reach. A range whose shared prefix has no cell
below two edits is skipped with all its words.

One edit leaves either the first half of a word as it is or the last half. So a query enters the
list of words only at the range that shares its first half, and the list of reversed words only at the
range that shares its last half; a pair that both would find counts in the first. A query meets
few blocks, whatever the size of the vocabulary; a half that very many words share is many blocks, of which those
whose common prefix is within one edit are met.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shipping import ship
from corpusloom.sources.store import drop_staged, stage

RUN = "[A-Za-z\\u00C0-\\u00FF]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_LETTERS, MIN_COUNT, DOMINANCE = 6, 5, 5
#: Words of a block, and the most blocks: their borders are broadcast. Beyond, blocks grow.
BLOCK_WORDS, MAX_BLOCKS = 8192, 65_536
#: Queries that one call of the scan takes; they bound its memory.
CHUNK = 1024
_LAST = "\U0010ffff"


def spelled_words(df: DataFrame, key: str, text: str, noise: int = 199, least: int = MIN_LETTERS) -> DataFrame:
    """(word): every maximal run of Latin letters in the whole texts, A-Z in lower case, with at least ``least``
    code points.

    Let h be the crc32 of ``<key>:<run>``. If ``noise`` divides it, the code point h mod length is left out, which
    plants misspellings. A null text has no words, a null key is written as nothing. Other columns are not read.
    """
    # A run is maximal in itself: it starts where no letter stands before and takes all that follow.
    runs = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"({RUN}{{{least},}})"))
    run = df.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.explode(runs).alias("run"))
    low = run.select(
        "key", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, UPPER.lower())).otherwise(F.col("run")).alias("run")
    )
    hashed = low.select("run", F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    without = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % noise == 0, without).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least)


class SortedWords:
    """A sorted list of distinct words: code points one after the other, and the LCP of each word with the one before."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.codes, self.starts, self.lengths = code_points(words)
        n = len(words)
        self.lcp = np.zeros(n + 1, dtype=np.int64)
        same = np.arange(1, n)
        depth = 0
        while len(same):
            some = np.minimum(self.lengths[same], self.lengths[same - 1]) > depth
            same = same[some]
            same = same[self.codes[self.starts[same] + depth] == self.codes[self.starts[same - 1] + depth]]
            self.lcp[same] += 1
            depth += 1
        self.longest = int(self.lengths.max(initial=0))
        self._by_lcp = np.argsort(self.lcp[:n], kind="stable")
        self._edges = np.searchsorted(self.lcp[self._by_lcp], np.arange(self.longest + 2))

    def parting(self, depth: int) -> np.ndarray:
        """Words that share ``depth`` code points and no more with the word before."""
        return self._by_lcp[self._edges[depth] : self._edges[depth + 1]]

    def range_of(self, prefix: str) -> tuple[int, int]:
        return bisect_left(self.words, prefix), bisect_right(self.words, prefix + _LAST)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all words, start of each word, length of each word)."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.append(codes, np.uint32(0)), np.cumsum(lengths) - lengths, lengths


def near_words(listed: SortedWords, queries: list[str], shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, list word) of every pair at exactly one edit that shares the query's first ``shared`` code points.

    The state of a query in a range of the list is its band: the cells one left of, on and one right of the
    diagonal, capped at two. ``shared`` is at least one and at most the query's length.
    """
    codes, starts, lengths = code_points(queries)
    opened = np.array([listed.range_of(q[:a]) for q, a in zip(queries, shared.tolist())], dtype=np.int64).reshape(-1, 2)
    found_q: list[np.ndarray] = []
    found_w: list[np.ndarray] = []
    query = low = high = np.zeros(0, dtype=np.int64)
    left = on = right = np.zeros(0, dtype=np.int8)
    depth, last = int(shared.min(initial=1)), int(shared.max(initial=0))

    def differs(points: np.ndarray, of: np.ndarray, place: int) -> np.ndarray:
        """Whether the list's code point is another than the query's at ``place``; beyond its end it is."""
        if place < 0:
            return np.full(len(of), 2, dtype=np.int8)
        inside = lengths[of] > place
        return np.where(inside, (codes[np.where(inside, starts[of] + place, 0)] != points).astype(np.int8), np.int8(2))

    while len(query) or depth <= min(last, listed.longest):
        entering = np.flatnonzero((shared == depth) & (opened[:, 0] < opened[:, 1]))
        if len(entering):
            # The shared code points cost nothing: the band is 1, 0, 1, the last where the query goes on.
            query = np.concatenate((query, entering))
            low, high = np.concatenate((low, opened[entering, 0])), np.concatenate((high, opened[entering, 1]))
            left = np.concatenate((left, np.ones(len(entering), np.int8)))
            on = np.concatenate((on, np.zeros(len(entering), np.int8)))
            right = np.concatenate((right, np.where(lengths[entering] > depth, 1, 2).astype(np.int8)))
        # A word that ends here is the first of its range; its distance is the cell at the query's length.
        ends = listed.lengths[low] == depth
        gap = lengths[query] - depth
        cell = np.where(gap == -1, left, np.where(gap == 0, on, np.where(gap == 1, right, 2)))
        hit = np.flatnonzero(ends & (cell == 1))
        found_q.append(query[hit])
        found_w.append(low[hit])
        # The ranges inside: the words that part from the one before at this depth open them.
        parting = listed.parting(depth)
        first, until = np.searchsorted(parting, low + 1), np.searchsorted(parting, high)
        n_inside = until - first + ~ends
        of = np.repeat(np.arange(len(query)), n_inside)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(n_inside) - n_inside, n_inside) - (~ends)[of]
        at = first[of] + nth
        begin = np.where(nth < 0, low[of], parting[np.clip(at, 0, max(len(parting) - 1, 0))] if len(parting) else 0)
        follows = at + 1 < until[of]
        finish = np.where(follows, parting[np.clip(at + 1, 0, max(len(parting) - 1, 0))] if len(parting) else 0, high[of])
        points = listed.codes[listed.starts[begin] + depth]
        q, e0, e1, e2 = query[of], left[of], on[of], right[of]
        n0 = np.minimum(e0 + differs(points, q, depth - 1), e1 + 1)
        n1 = np.minimum(np.minimum(e1 + differs(points, q, depth), e2 + 1), n0 + 1)
        n1 = np.where(lengths[q] >= depth + 1, n1, 2)
        n2 = np.minimum(e2 + differs(points, q, depth + 1), n1 + 1)
        n2 = np.where(lengths[q] >= depth + 2, n2, 2)
        alive = np.flatnonzero(np.minimum(np.minimum(n0, n1), n2) <= 1)
        query, low, high = q[alive], begin[alive], finish[alive]
        left, on, right = (np.minimum(n[alive], 2).astype(np.int8) for n in (n0, n1, n2))
        depth += 1
    return np.concatenate(found_q or [query]), np.concatenate(found_w or [low])


def same_front(listed: list[str], queries: list[str], q: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Whether each pair, written from the back, shares the first half of the query."""
    pairs = ((queries[a], listed[b]) for a, b in zip(q.tolist(), w.tolist()))
    same = (x[-(len(x) // 2) :] == y[-(len(x) // 2) :] for x, y in pairs)
    return np.fromiter(same, dtype=bool, count=len(q))


def _prefix_edits(query: str, prefix: str) -> bool:
    """Whether some word that starts with ``prefix`` may be within one edit of ``query``."""
    n = min(len(query), len(prefix))
    i = next((k for k in range(n) if query[k] != prefix[k]), n)
    if i == len(prefix):
        return True
    rest = prefix[i + 1 :]
    # Replaced, missing in the query, or one too many in the query.
    return any(
        tail[: len(part)] == part
        for tail, part in ((query[i + 1 :], rest), (query[i:], rest), (query[i + 1 :], prefix[i:]))
    )


def _blocks_of(query: str, shared: int, firsts: list[str], lasts: list[str]) -> list[int]:
    """Blocks that may hold a word within one edit of ``query`` that shares its first ``shared`` code points."""
    prefix = query[:shared]
    low, high = bisect_left(lasts, prefix), bisect_right(firsts, prefix + _LAST)
    if high - low <= 2:
        return list(range(low, high))
    kept = []
    for b in range(low, high):
        first, last = firsts[b], lasts[b]
        n = next((k for k, (x, y) in enumerate(zip(first, last)) if x != y), min(len(first), len(last)))
        if _prefix_edits(query, first[:n]):
            kept.append(b)
    return kept


def _sorted_blocks(vocabulary: DataFrame, n_words: int, backwards: bool) -> DataFrame:
    """(block, word, n) written in blocks of neighbouring words; ``word`` is reversed if ``backwards``."""
    n_blocks = max(1, -(-n_words // max(BLOCK_WORDS, -(-n_words // MAX_BLOCKS))))
    word = F.reverse("word") if backwards else F.col("word")
    ranged = vocabulary.select(word.alias("word"), "n").repartitionByRange(n_blocks, "word").sortWithinPartitions("word")
    return stage(ranged.withColumn("block", F.spark_partition_id()), "sorted-words")


def _pairs_in_blocks(blocks: DataFrame, backwards: bool) -> DataFrame:
    """(word, n, n_near, near_n, near): for each query and block it meets, its near words there: their number,
    and the one with the largest count, of equal ones the smallest."""
    spark = blocks.sparkSession
    borders = blocks.groupBy("block").agg(F.min("word").alias("first"), F.max("word").alias("last")).orderBy("block").toArrow()
    shared_borders = spark.sparkContext.broadcast(
        (borders["block"].to_pylist(), borders["first"].to_pylist(), borders["last"].to_pylist())
    )

    def shared_points(word: str) -> int:
        half = len(word) // 2
        return len(word) - half if backwards else half

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, firsts, lasts = shared_borders.value
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start in range(0, len(words), CHUNK):
                to: dict[int, list[int]] = {}
                for i in range(start, min(start + CHUNK, len(words))):
                    for b in _blocks_of(words[i], shared_points(words[i]), firsts, lasts):
                        to.setdefault(names[b], []).append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(to), pa.int32()),
                     pa.array([[words[i] for i in at] for at in to.values()], pa.list_(pa.string())),
                     pa.array([[counts[i] for i in at] for at in to.values()], pa.list_(pa.int64()))],
                    names=["q_block", "queries", "q_counts"],
                )

    # Rows come in the order of their blocks, so a chunk of queries meets few.
    queries = blocks.select("word", "n").mapInArrow(route, "q_block int, queries array<string>, q_counts array<bigint>")
    listed = blocks.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("listed"))
    met = queries.join(listed, F.col("q_block") == F.col("block")).select("queries", "q_counts", "listed.word", "listed.n")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                asked, asked_n = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                words, counts = batch.column(2)[r].as_py(), batch.column(3)[r].values.to_numpy()
                shared = np.fromiter(map(shared_points, asked), dtype=np.int64, count=len(asked))
                q, w = near_words(SortedWords(words), asked, shared)
                if backwards:
                    other = ~same_front(words, asked, q, w)
                    q, w = q[other], w[other]
                    asked, words = [x[::-1] for x in asked], [x[::-1] for x in words]
                # Of each query the near word of largest count, ties to the smallest.
                rank = np.empty(len(words), dtype=np.int64)
                rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
                order = np.lexsort((rank[w], -counts[w], q))
                q, w = q[order], w[order]
                opens = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))[: len(q)])
                best = np.full(len(asked), -1, dtype=np.int64)
                best[q[opens]] = w[opens]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked, pa.string()), pa.array(asked_n, pa.int64()),
                     pa.array(np.bincount(q, minlength=len(asked)).astype(np.int64)),
                     pa.array([int(counts[b]) if b >= 0 else None for b in best.tolist()], pa.int64()),
                     pa.array([words[b] if b >= 0 else None for b in best.tolist()], pa.string())],
                    names=["word", "n", "n_near", "near_n", "near"],
                )

    return met.mapInArrow(scan, "word string, n bigint, n_near bigint, near_n bigint, near string")


def near_forms(vocabulary: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, n, n_near, form, form_n) for ``vocabulary`` (word, n) of distinct words with at least two code points.

    Near are words at exactly one inserted, deleted or replaced code point. The form is the near word of
    largest n, ties to the smallest, if that n is at least ``dominance`` times the word's own. Null words are left out.
    """
    ship(vocabulary)
    vocabulary = vocabulary.where("word is not null")
    n_words = vocabulary.count()
    sides = []
    for backwards in (False, True):
        blocks = _sorted_blocks(vocabulary, n_words, backwards)
        sides.append(_pairs_in_blocks(blocks, backwards))
    # Sorted by falling count, then by word.
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near"))))
    every = vocabulary.select(
        "word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("bigint").alias("near_n"), F.lit(None).cast("string").alias("near")
    )
    found = every.unionByName(sides[0]).unionByName(sides[1]).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")
    )
    strong = -F.col("best.less") >= F.col("n") * dominance
    return found.select(
        "word", "n", "n_near", F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")
    )


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` with ``root``: the last form that the forms lead to from a word, itself without any.

    Every step multiplies the count by ``DOMINANCE`` at least, so a chain is as long as a logarithm of the
    largest count; each round doubles how far a root reaches and is a written table.
    """
    links = forms.where("form is not null").select("word", F.col("form").alias("root"))
    last = links = stage(links, "forms")
    while True:
        further = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        links = stage(links.join(further, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ), "roots")
        drop_staged(last)
        last = links
        if not links.where("moved").limit(1).count():
            break
    roots = links.select(F.col("word").alias("r_word"), "root")
    joined = forms.join(roots, F.col("word") == F.col("r_word"), "left")
    return joined.select(*forms.columns, F.coalesce("root", "word").alias("root"))


def group_spellings(df: DataFrame, key: str, text: str, min_count: int = MIN_COUNT, dominance: int = DOMINANCE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that occurs ``min_count`` times in all texts.

    Words are those of :func:`spelled_words`; forms and ties as in :func:`near_forms`. Repeated rows count each.
    Tables without such words give no rows. A word of any length is compared as a whole.
    """
    words = spelled_words(df, key, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = stage(words.where(F.col("n") >= min_count), "vocabulary")
    forms = stage(near_forms(vocabulary, dominance), "near-forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")

