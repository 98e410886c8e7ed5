"""Removing long repeats across texts by recompression (operator 3).

Words are the first symbols. A round joins runs of equal symbols, and pairs whose left and right symbol
fall into the left and the right half of the alphabet, into one symbol each, named by what it
spells, the same everywhere. Whether two neighbours are joined depends on the two alone, so equal
substrings have equal symbols inside, up to a rim that each round widens by a symbol.

1. Each window of ``window`` words picks, among the symbols of the last round that it settles by
   itself, the one with the smallest name; its name with the rim is the window's anchor. Equal windows
   pick equal anchors, and neighbouring windows mostly the same one.
2. Anchors are gathered by name. Only those of several texts can belong to a repeat. Symbols of
   higher rounds are gathered too: all texts but the one with the smallest key repeat one as a whole,
   and so every window inside it.
3. Windows with a shared anchor that no higher symbol has settled are compared by their own
   128-bit names: all texts but the one with the smallest key repeat them.

Before each shuffle a task settles what it can among its own rows: of a name that several of them have, it
sends one row on and keeps the others as decided. A name that a third of all texts share is thus
one row for each batch of input, wherever it meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.hashing import SpanHashes, mix, word_hashes
from corpusloom.llm.keyfilter import key_filter
from corpusloom.llm.shipping import ship
from corpusloom.llm.words import split_words, text_slices
from corpusloom.llm.workers import released
from corpusloom.sources.store import drop_staged, stage

WINDOW = 13
ROUNDS, HIGH_ROUNDS = 2, 6
SLICE_BYTES = 2 << 20
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def recompress(words: np.ndarray, rows: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first word, end) of what settles each symbol of the last round.

    ``words`` are the texts' words one after the other, ``rows`` the text of each. The span that settles a
    symbol holds its neighbours, whose kinds decide where it begins and ends; for the first and
    last symbol of a text it reaches outside the text, so no window settles them.
    """
    spans = SpanHashes(words)
    n = len(words)
    start, end = np.arange(n), np.arange(1, n + 1)
    low, high = start, end
    name, row = words, rows
    for r in range(rounds):
        right = (mix(name + np.uint64(r + 1)) & np.uint64(1)).astype(bool)
        joined = (row[1:] == row[:-1]) & ((name[1:] == name[:-1]) | (~right[:-1] & right[1:]))
        first = np.flatnonzero(np.concatenate(([True], ~joined))) if len(name) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(name)) - 1
        same_before = np.concatenate(([False], row[first[1:]] == row[last[:-1]])) if len(first) else np.zeros(0, bool)
        same_after = np.append(same_before[1:], False)
        before = np.where(same_before, low[np.maximum(first - 1, 0)], low[first] - 1)
        after = np.where(same_after, high[np.minimum(last + 1, max(len(name) - 1, 0))], high[last] + 1)
        start, end, low, high, row = start[first], end[last], before, after, row[first]
        name = spans.of(start, end)
    return name, low, high


def window_anchors(words: np.ndarray, rows: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, SpanHashes]:
    """(first word, text, anchor) of every window, and the span hashes."""
    spans = SpanHashes(words)
    n_windows = np.maximum(counts - window + 1, 0)
    text = np.repeat(np.arange(len(counts)), n_windows)
    firsts = np.cumsum(counts) - counts
    at = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + firsts[text]
    name, low, high = recompress(words, rows)
    order = mix(name ^ _SECOND)
    # Settling spans begin and end in rising order: a window's own are neighbours.
    begin = np.searchsorted(low, at, side="left")
    until = np.searchsorted(high, at + window, side="right")
    best = np.full(len(at), np.iinfo(np.uint64).max, dtype=np.uint64)
    pick = np.full(len(at), -1, dtype=np.int64)
    for step in range(window):
        j = begin + step
        some = np.flatnonzero(j < until)
        if not len(some):
            break
        value = order[j[some]]
        better = (value < best[some]) | (pick[some] < 0)
        chosen = some[better]
        best[chosen] = value[better]
        pick[chosen] = j[chosen]
    anchor = spans.of(at, at + window) ^ _SECOND
    found = pick >= 0
    anchor[found] = spans.of(low[pick[found]], high[pick[found]])
    return at, text, anchor, spans


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    counts, index, distinct = split_words(texts)
    hashes = word_hashes(distinct)
    words = hashes[index] if len(index) else np.zeros(0, np.uint64)
    return words, np.repeat(np.arange(len(counts)), counts), counts, index, distinct


def _first_of_each(names: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (name, key): whether it has the smallest key of its name, and whether the name has several keys."""
    order = np.lexsort((keys, names))
    n, k = names[order], keys[order]
    opens = np.concatenate(([True], n[1:] != n[:-1])) if len(n) else np.zeros(0, bool)
    group = np.cumsum(opens) - 1
    least = k[opens][group] if len(n) else k
    first = np.empty(len(n), bool)
    first[order] = k == least
    several = np.zeros(int(opens.sum()), bool)
    np.logical_or.at(several, group, k != least)
    out = np.empty(len(n), bool)
    out[order] = several[group] if len(n) else several
    return first, out


def high_symbols(words: np.ndarray, rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, first word, end, text) of what settles the symbols of the last round, if a window fits in."""
    _, low, high = recompress(words, rows, HIGH_ROUNDS)
    ends = np.append(np.flatnonzero(rows[1:] != rows[:-1]) + 1, len(rows)) if len(rows) else np.zeros(0, np.int64)
    row = rows[np.clip((low + high) // 2, 0, max(len(rows) - 1, 0))] if len(rows) else rows
    begins = np.zeros(int(rows.max()) + 1 if len(rows) else 0, dtype=np.int64)
    stops = np.zeros_like(begins)
    if len(rows):
        stops[rows[ends - 1]] = ends
        begins[rows[ends - 1]] = np.append(0, ends[:-1])
    inside = (high - low >= window) & (low >= begins[row]) & (high <= stops[row]) if len(rows) else np.zeros(0, bool)
    low, high, row = low[inside], high[inside], row[inside]
    return SpanHashes(words).of(low, high) ^ mix(_SECOND + np.zeros(1, np.uint64)), low, high, row


def _listed(names: np.ndarray, rows: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether each name is in its own row's list."""
    listed = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    of = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy()).astype(np.uint64)
    return np.isin(names ^ mix(rows.astype(np.uint64)), listed ^ mix(of))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def remove_repeats(
    df: DataFrame, key: str, text: str, window: int = WINDOW, carry: tuple[str, ...] = ()
) -> DataFrame:
    """(key, text, kept, n_words, n_removed, rest): each whole text without the words of repeated windows.

    A word goes if a window over it, of ``window`` words, has a word sequence that also starts in a text
    with a smaller key. Windows are judged on the input. ``kept`` is the other words, unchanged,
    joined by one space. Null texts have no words. Rows with a null key keep all their words and
    hide no others' windows; rows that repeat a key are each cut by smaller keys only. Keys are whole
    numbers. ``rest`` is a struct of the columns in ``carry``, null without any; others are not read.
    """
    ship(df)
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("string")
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), rest.alias("rest"))
    kind = rows.schema["rest"].dataType
    rest_type, rest_arrow = kind.simpleString(), to_arrow_type(kind)
    usable = rows.where("key is not null and text is not null")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, keys = [], []
            for part in text_slices(batch, "text", SLICE_BYTES):
                words, row, counts, _, _ = _words(part.column(1))
                _, text_of, anchor, _ = window_anchors(words, row, counts, window)
                change = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text_of[1:] != text_of[:-1])))[: len(anchor)]
                high, _, _, high_row = high_symbols(words, row, window)
                key_ = part.column(0).to_numpy()
                names += [anchor[change], high]
                keys += [key_[text_of[change]], key_[high_row]]
            name, key_ = np.concatenate(names), np.concatenate(keys)
            order = np.lexsort((name, key_))
            name, key_ = name[order], key_[order]
            once = np.concatenate(([True], (name[1:] != name[:-1]) | (key_[1:] != key_[:-1])))[: len(name)]
            name, key_ = name[once], key_[once]
            first, several = _first_of_each(name, key_)
            # Others than the first are decided: they go on under a name of their own.
            own = np.where(first, name, mix(name ^ mix(key_.astype(np.uint64))))
            yield pa.RecordBatch.from_arrays(
                [_signed(own), pa.array(key_), pa.array(several & first), pa.array(name.view(np.int64), mask=first)],
                names=["name", "key", "shared", "anchor"],
            )

    # ``anchor`` is the name of a decided row, which repeats a smaller key.
    found = usable.select("key", "text").mapInArrow(released(anchors), "name bigint, key bigint, shared boolean, anchor bigint")
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # A window sorts once and keeps rows as they are; a name has a row for each batch of input at most.
    of_name = W.partitionBy("name")
    together = (
        found.repartition(parts, "name")
        .withColumn("least", F.min("key").over(of_name))
        .withColumn("shared", F.max("shared").over(of_name))
        .withColumn("n", F.count(F.lit(1)).over(of_name))
    )
    decided = F.col("anchor").isNotNull()
    shared = together.where(F.col("shared") | decided | (F.col("n") > 1)).select(
        F.col("key").alias("s_key"),
        F.coalesce("anchor", "name").alias("anchor"),
        (decided | (F.col("key") > F.col("least"))).alias("later"),
    )
    by_text = stage(
        shared.groupBy("s_key").agg(
            F.collect_list("anchor").alias("anchors"), F.collect_list(F.when(F.col("later"), F.col("anchor"))).alias("later")
        ),
        "shared-symbols",
    )
    some = key_filter(by_text, "s_key")
    marked = (
        usable.select("key", "text").where(some("key"))
        .join(by_text, F.col("key") == F.col("s_key"))
        .select("key", "text", "anchors", "later")
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans that repeat smaller keys for certain, and a row for each window to compare."""
        names = ["key", "name", "place", "length", "h1", "h2"]

        def out(key_, name, place, length, h1, h2) -> Iterator[pa.RecordBatch]:
            for start in range(0, len(key_), 1 << 16):
                cut = slice(start, start + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key_[cut]), pa.array(name[cut]), pa.array(place[cut].astype(np.int32)),
                     pa.array(length[cut].astype(np.int32)), _signed(h1[cut]), _signed(h2[cut])],
                    names=names,
                )

        for batch in batches:
            held = []
            for part in text_slices(batch, "text", SLICE_BYTES):
                words, row, counts, _, _ = _words(part.column(1))
                key_, ends = part.column(0).to_numpy(), np.cumsum(counts)
                firsts = ends - counts
                at, text_of, anchor, spans = window_anchors(words, row, counts, window)
                name = spans.of(firsts, ends).view(np.int64)
                hit = _listed(anchor, text_of, part.column(2))
                high, low, until, high_row = high_symbols(words, row, window)
                settled = _listed(high, high_row, part.column(3))
                low, until, high_row = low[settled], until[settled], high_row[settled]
                yield from out(
                    key_[high_row], name[high_row], low - firsts[high_row], until - low,
                    mix(name[high_row].view(np.uint64) ^ mix(key_[high_row].astype(np.uint64)) + low.astype(np.uint64)), low.astype(np.uint64),
                )
                # Windows inside a settled symbol are covered by it.
                covered = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(covered, low, 1)
                np.subtract.at(covered, np.maximum(until - window + 1, low), 1)
                hit &= np.cumsum(covered)[at] == 0
                at, text_of = at[hit], text_of[hit]
                second = SpanHashes(mix(words ^ _SECOND))
                held.append((key_[text_of], name[text_of], at - firsts[text_of], spans.of(at, at + window), second.of(at, at + window)))
            k, name, place, h1, h2 = map(np.concatenate, zip(*held))
            first, _ = _first_of_each(h1, k)
            later = np.flatnonzero(~first)
            # What repeats a smaller key of this batch is certain; neighbours go on as one span.
            opens = np.concatenate(([True], (np.diff(later) > 1) | (np.diff(place[later]) != 1) | (np.diff(k[later]) != 0)))[: len(later)]
            heads = later[opens]
            lengths = np.diff(np.append(np.flatnonzero(opens), len(later))) + window - 1
            yield from out(
                k[heads], name[heads], place[heads], lengths,
                mix(name[heads].view(np.uint64) ^ mix(k[heads].astype(np.uint64)) + place[heads].astype(np.uint64)), h2[heads],
            )
            ones = np.flatnonzero(first)
            yield from out(k[ones], name[ones], place[ones], np.zeros(len(ones), np.int64), h1[ones], h2[ones])

    told = marked.mapInArrow(released(windows), "key bigint, name bigint, place int, length int, h1 bigint, h2 bigint")
    # A length says that the span is certain; rows to compare have none.
    met = (
        told.repartition(parts, "h1")
        .withColumn("least", F.min("key").over(W.partitionBy("h1", "h2")))
    )
    covered = met.where((F.col("length") > 0) | (F.col("key") > F.col("least"))).select(
        F.col("key").alias("c_key"),
        F.struct(
            "name", "place", F.when(F.col("length") > 0, F.col("length")).otherwise(F.lit(window)).alias("length")
        ).alias("span"),
    )
    spans = stage(covered.groupBy("c_key").agg(F.collect_list("span").alias("spans")), "repeats")
    drop_staged(by_text)
    touched = key_filter(spans, "c_key")
    flagged = rows.withColumn("touched", F.coalesce(touched("key"), F.lit(False)))
    cut = flagged.where("touched").join(spans, F.col("key") == F.col("c_key"), "left").select("key", "text", "rest", "spans")
    whole = flagged.where(~F.col("touched")).select("key", "text", "rest", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                words, row, counts, index, distinct = _words(part.column(1))
                ends = np.cumsum(counts)
                firsts = ends - counts
                edge = np.zeros(len(index) + 1, dtype=np.int64)
                lists = part.column(3)
                lengths = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
                if lengths.any():
                    found = lists.drop_null().flatten()
                    of = np.repeat(np.arange(len(counts)), lengths)
                    own = found.field("name").to_numpy() == SpanHashes(words).of(firsts, ends).view(np.int64)[of]
                    at = (found.field("place").to_numpy() + firsts[of])[own]
                    np.add.at(edge, at, 1)
                    np.subtract.at(edge, at + found.field("length").to_numpy()[own], 1)
                keep = np.cumsum(edge[:-1]) == 0
                left = np.bincount(row[keep], minlength=len(counts)).astype(np.int64)
                offsets = np.concatenate(([0], np.cumsum(left)))
                kept = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), distinct.take(pa.array(index[keep])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pc.binary_join(kept, " "), pa.array(counts), pa.array(counts - left),
                     part.column(2).cast(rest_arrow)],
                    names=["key", "text", "kept", "n_words", "n_removed", "rest"],
                )

    schema = f"key bigint, text string, kept string, n_words bigint, n_removed bigint, rest {rest_type}"
    return cut.mapInArrow(released(cut_out), schema).unionByName(whole.mapInArrow(released(cut_out), schema))
