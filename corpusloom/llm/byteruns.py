"""Removal of every byte that a repeated string covers, by suffix arrays of content-made shards (operator 12).

1. Each window of ``window`` bytes picks the 64-byte gram in it with the smallest hash, the leftmost of equal ones.
   Equal windows pick the same gram at the same place, and neighbours mostly share theirs. What the windows
   of one gram cover is a segment; a window belongs to one segment only.
2. Grams are counted. Only those that occur twice can belong to a repeated window; the segments of such a gram are a
   shard, so equal windows always meet in one. Equal segments meet as one row for each batch of input.
3. Each shard's segments are one text, whose suffix array is made by induced sorting (``suffix.py``), many shards in
   step, and whose permuted common prefixes say which windows occur again.
4. Texts with repeated windows are joined with their spans and cut.

A gram with more segments than a shard may hold, such as those at the rims of a passage that very many texts share, is
split by window: a window's own 128-bit name is then the shard, which holds equal strings only, and
nothing is left to sort. So no shard grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bitset import bits_for, collect_bits, holds, place_of, places_of
from corpusloom.llm.hashing import mix
from corpusloom.llm.shipping import ship
from corpusloom.llm.suffix import common_prefixes, dense, suffix_arrays
from corpusloom.llm.workers import released
from corpusloom.sources.store import drop_staged, stage

WINDOW, GRAM = 200, 64
#: Bytes of text looked at together, and of segments gathered before rows go out.
SLICE_BYTES, GATHERED_BYTES = 1 << 20, 8 << 20
#: Different segments of a shard at most.
SHARD_SEGMENTS = 256
#: Bytes of segments whose suffix arrays are made in step, and how much larger the next class of shards is: the
#: steps of a round are as many as its longest shard has bytes, so like goes with like.
STEP_BYTES, CLASS_BITS = 5 << 17, 1
#: Places of the sets of names that the executors get: 16 a name between these bounds, so 32 MB at most.
MIN_BITS, MAX_BITS = 16, 28
_CODE = np.uint64((1 << 24) - 1)
_DECIDED, _SEGMENT, _WINDOW = 0, 1, 2


@dataclass
class Segments:
    """Segments of one slice: the row of each, first window (in its text), windows, name, place in ``data``."""

    data: np.ndarray
    row: np.ndarray
    place: np.ndarray
    windows: np.ndarray
    name: np.ndarray
    at: np.ndarray
    content: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, start of each text in them and the end of the last); null texts are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), places


def _slices(places: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """(first row, borders of its rows, offset in the first row) of slices of bounded size. A longer text comes in
    several, each with ``window`` - 1 bytes of the next, so every window is in one."""
    row, n = 0, len(places) - 1
    while row < n:
        begin, end = int(places[row]), int(places[row + 1])
        if end - begin > SLICE_BYTES + window:
            for offset in range(0, end - begin - window + 1, SLICE_BYTES):
                yield row, np.array([begin + offset, min(end, begin + offset + SLICE_BYTES + window - 1)]), offset
            row += 1
        else:
            stop = max(row + 1, int(np.searchsorted(places, begin + SLICE_BYTES + window, side="right")) - 1)
            yield row, places[row : stop + 1], 0
            row = stop


def segments(texts: pa.Array, window: int = WINDOW) -> Iterator[Segments]:
    """The segments of whole texts, slice by slice."""
    every, places = text_bytes(texts)
    gram = min(GRAM, window)
    span = window - gram + 1
    for first_row, borders, offset in _slices(places, window):
        data = every[borders[0] : borders[-1]]
        borders = borders - borders[0]
        n = len(data) - window + 1
        sizes = np.diff(borders)
        fits = np.maximum(sizes - window + 1, 0)
        if n <= 0 or not fits.any():
            continue
        hashed = _gram_hashes(data, gram)
        order = (hashed & ~_CODE) | np.arange(len(hashed), dtype=np.uint64)
        pick = (_sliding_least(order, span)[:n] & _CODE).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), fits)
        start = np.arange(len(row)) - np.repeat(np.cumsum(fits) - fits, fits) + borders[row]
        anchor = pick[start]
        opens = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))))
        windows = np.diff(np.append(opens, len(row)))
        at, of = start[opens], row[opens]
        # A sum of gram hashes stands for the content where segments are only counted.
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashed ^ np.uint64(gram)))))
        content = sums[at + windows + window - gram] - sums[at]
        yield Segments(data, of + first_row, at - borders[of] + offset, windows, mix(hashed[anchor[opens]]), at, content)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` bytes, eight at a time."""
    n = len(data) - gram + 1
    out = np.zeros(n, dtype=np.uint64)
    padded = np.append(data, np.zeros(8, dtype=np.uint8))
    eight = np.ndarray(shape=(len(data),), dtype="<u8", buffer=padded, strides=(1,))
    for start in [*range(0, gram - 7, 8), *([gram - 8] if gram % 8 and gram > 8 else [])]:
        out = mix(out ^ eight[start : start + n]) + np.uint64(start + 1)
    if gram < 8:
        out = mix(eight[:n] & np.uint64((1 << 8 * gram) - 1))
    return out


def _sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` neighbours: of the rest of one stretch of ``span`` and the start of the next."""
    n = len(values) - span + 1
    if n <= 0:
        return np.zeros(0, values.dtype)
    stretches = -(-len(values) // span) + 1
    padded = np.full(stretches * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(-1, span)
    so_far = np.minimum.accumulate(table, axis=1).ravel()
    to_come = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_come[:n], so_far[span - 1 : span - 1 + n])


def repeated_windows(contents: list[np.ndarray], shards: np.ndarray, window: int) -> list[np.ndarray]:
    """Of each segment, whether each window occurs elsewhere in its shard; ``shards`` says which, rising."""
    # Bytes 0xFE and 0xFF are in no UTF-8 text: one parts segments, the other ends a shard, as its smallest symbol.
    sizes = np.fromiter(map(len, contents), dtype=np.int64, count=len(contents))
    ends_shard = np.append(shards[1:] != shards[:-1], True)
    units = np.full(int(sizes.sum()) + len(sizes) + int(ends_shard.sum()), 0xFF, dtype=np.uint8)
    begins = np.cumsum(sizes + 1 + ends_shard) - (sizes + 1 + ends_shard)
    for content, begin in zip(contents, begins.tolist()):
        units[begin : begin + len(content)] = content
    units[begins + sizes] = 0xFE
    units += np.uint8(1)
    starts = begins[np.append(True, ends_shard[:-1])]
    shard = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(units))))
    order = suffix_arrays(dense(shard * 256 + units, len(starts) * 256), starts)
    common, other = common_prefixes(units, starts, order)
    again = np.zeros(len(units), dtype=bool)
    hit = np.flatnonzero(common >= window)
    again[hit] = True
    again[other[hit]] = True
    return [again[b : b + s - window + 1] for b, s in zip(begins.tolist(), sizes.tolist())]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of each run of true values."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    starts = np.flatnonzero(edge == 1)
    return starts, np.flatnonzero(edge == -1) - starts


def remove_byte_runs(df: DataFrame, key: str, text: str, window: int = WINDOW) -> DataFrame:
    """(key, text, kept, n_bytes, removed): the bytes of each whole text that no repeated window covers.

    A string of ``window`` bytes is repeated if it also starts anywhere else, in the same text or another; strings lie in
    one text. All are judged on the input. ``kept`` is binary: what is left, joined up; ``removed`` is an array of
    (place, length), the maximal runs removed, in order. Null texts are empty; keys, null or repeated, play no part,
    so rows with the same text lose the same bytes (all, from ``window`` bytes on). Other columns are not read.
    """
    ship(df)
    spark = df.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(body).alias("t1"), F.xxhash64(F.lit("second"), body).alias("t2")
    )
    usable = rows.where(F.octet_length("text") >= window).select("t1", "t2", "text")

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            size = 0
            for part in segments(batch.column(2), window):
                held.append((part.name, part.content))
                size += len(part.data)
                if size > GATHERED_BYTES:
                    yield _counted(held)
                    held, size = [], 0
            if held:
                yield _counted(held)

    # Dealt by name once: both counts find their rows together.
    met = usable.mapInArrow(released(names), "name bigint, content bigint, n int").repartition("name")
    contents = met.groupBy("name", "content").agg(F.sum("n").alias("n"))
    counted = contents.groupBy("name").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("segments"))
    several = stage(counted.where("n > 1").select("name", (F.col("segments") > SHARD_SEGMENTS).alias("wide")), "repeated-names")
    bits = bits_for(several.count(), 16, MIN_BITS, MAX_BITS)
    met = several.select(place_of(F.col("name"), bits).alias("place"), "wide")
    known = spark.sparkContext.broadcast((collect_bits(met, "place", bits), collect_bits(met.where("wide"), "place", bits)))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, wide = known.value
        for batch in batches:
            out = _Gathered(batch.column(0).to_numpy(), batch.column(1).to_numpy(), window)
            for part in segments(batch.column(2), window):
                places = places_of(part.name, bits)
                out.add(part, holds(repeated, places), holds(wide, places))
                if out.size > GATHERED_BYTES:
                    yield from out.rows()
            yield from out.rows()

    schema = "name bigint, d1 bigint, d2 bigint, kind int, several boolean, t1 bigint, t2 bigint, place bigint, windows int, content binary"
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = usable.mapInArrow(released(gathered), schema).repartition(parts, "name").sortWithinPartitions("name", "d1", "d2")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(window)
        for batch in batches:
            yield from shards.take(batch)
        yield from shards.finish()

    spans = dealt.mapInArrow(released(judge), "t1 bigint, t2 bigint, place bigint, length bigint")
    by_text = spans.groupBy(F.col("t1").alias("s1"), F.col("t2").alias("s2")).agg(
        F.collect_set(F.struct("place", "length")).alias("spans")
    )
    by_text = stage(by_text, "repeated-spans")
    drop_staged(several)
    text_bits = bits_for(by_text.count(), 16, MIN_BITS, MAX_BITS)
    touched = spark.sparkContext.broadcast(collect_bits(by_text.select(place_of(F.col("s1"), text_bits).alias("place")), "place", text_bits))

    @F.pandas_udf("boolean")
    def may_lose(hashed):
        import pandas as pd

        return pd.Series(holds(touched.value, places_of(hashed.to_numpy().astype(np.int64), text_bits)))

    flagged = rows.select("key", "text", "t1", "t2", (F.octet_length("text") >= window).alias("long"))
    flagged = flagged.withColumn("met", F.coalesce(F.col("long"), F.lit(False)) & may_lose("t1"))
    joined = flagged.where("met").join(by_text, (F.col("t1") == F.col("s1")) & (F.col("t2") == F.col("s2")), "left")
    removed = "array<struct<place:bigint,length:bigint>>"
    cut = joined.select("key", "text", "spans").mapInArrow(_cut, f"key {rows.schema['key'].dataType.simpleString()}, text string, kept binary, n_bytes bigint, removed {removed}")
    whole = flagged.where("not met").select(
        "key", "text", F.coalesce("text", F.lit("")).cast("binary").alias("kept"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), F.array().cast(removed).alias("removed"),
    )
    return cut.unionByName(whole)


def _counted(held: list[tuple]) -> pa.RecordBatch:
    """Each name and content once, and how often."""
    name, content = map(np.concatenate, zip(*held))
    order = np.lexsort((content, name))
    name, content = name[order], content[order]
    at = np.flatnonzero(np.concatenate(([True], (name[1:] != name[:-1]) | (content[1:] != content[:-1]))))
    n = np.diff(np.append(at, len(name))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(_signed(name[at])), pa.array(_signed(content[at])), pa.array(n)], names=["name", "content", "n"]
    )


class _Gathered:
    """Segments of repeated names on their way to their shards: of equal ones the first, the rest decided."""

    def __init__(self, t1: np.ndarray, t2: np.ndarray, window: int) -> None:
        self.t1, self.t2, self.window = t1, t2, window
        self._begin()

    def _begin(self) -> None:
        self.first: dict[bytes, int] = {}
        self.several: list[bool] = []
        self.sent: list[tuple] = []
        self.decided: list[tuple[int, int, int]] = []
        self.size = 0

    def _meet(self, digest: bytes, row: tuple) -> None:
        at = self.first.setdefault(digest, len(self.sent))
        if at == len(self.sent):
            self.sent.append((*row, digest))
            self.several.append(False)
            self.size += 64 + len(row[-1] or b"")
        else:
            self.several[at] = True
            self.decided.append((row[2], row[3], row[4]))
            self.size += 24

    def add(self, part: Segments, repeated: np.ndarray, wide: np.ndarray) -> None:
        window, digest_of = self.window, xxhash.xxh3_128_digest
        columns = (wide, _signed(part.name), part.row, part.place, part.windows, part.at)
        for split, name, of, place, windows, begin in zip(*(c[repeated].tolist() for c in columns)):
            if split:
                for k in range(windows):
                    digest = digest_of(part.data[begin + k : begin + k + window])
                    # A window's name is its content, whatever gram it picked.
                    self._meet(digest, (_WINDOW, int.from_bytes(digest[:8], "little", signed=True), of, place + k, 1, None))
            else:
                content = part.data[begin : begin + windows + window - 1].tobytes()
                self._meet(digest_of(content), (_SEGMENT, name, of, place, windows, content))

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.sent:
            return
        kind, name, of, place, windows, content, digest = zip(*self.sent)
        halves = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
        yield self._batch(name, halves[:, 0], halves[:, 1], kind, self.several, of, place, windows, content)
        if self.decided:
            of, place, windows = (np.array(x, dtype=np.int64) for x in zip(*self.decided))
            order = np.lexsort((place, of))
            of, place, windows = of[order], place[order], windows[order]
            # Neighbours go on as one.
            opens = np.concatenate(([True], (of[1:] != of[:-1]) | (place[1:] != place[:-1] + windows[:-1])))
            heads = np.flatnonzero(opens)
            windows = np.add.reduceat(windows, heads)
            of, place = of[heads], place[heads]
            spread = _signed(mix(self.t1[of].astype(np.int64).view(np.uint64) + place.astype(np.uint64)))
            none = np.zeros(len(heads), dtype=np.int64)
            yield self._batch(spread, none, none, none + _DECIDED, none.astype(bool), of, place, windows, [None] * len(heads))
        self._begin()

    def _batch(self, name, d1, d2, kind, several, of, place, windows, content) -> pa.RecordBatch:
        of = np.asarray(of, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(name, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(kind, pa.int32()),
             pa.array(several, pa.bool_()), pa.array(self.t1[of]), pa.array(self.t2[of]), pa.array(place, pa.int64()),
             pa.array(windows, pa.int32()), pa.array(content, pa.binary())],
            names=["name", "d1", "d2", "kind", "several", "t1", "t2", "place", "windows", "content"],
        )


class _Shards:
    """Rows sorted by name and digest, judged shard by shard.

    Equal segments are neighbours: from the second on they are decided and only the first is kept, so a segment
    of very many rows takes the room of one.
    """

    def __init__(self, window: int) -> None:
        self.window = window
        self.open: pa.RecordBatch | None = None
        self.waiting: dict[int, list[pa.RecordBatch]] = {}
        self.size: dict[int, int] = {}

    def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        decided = batch.column("kind").to_numpy() == _DECIDED
        yield from self._whole(batch, np.flatnonzero(decided))
        batch = batch.take(pa.array(np.flatnonzero(~decided)))
        if self.open is not None:
            batch = pa.concat_batches([self.open, batch])
        if not batch.num_rows:
            return
        name, d1, d2 = (batch.column(c).to_numpy() for c in ("name", "d1", "d2"))
        opens = np.concatenate(([True], (name[1:] != name[:-1]) | (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])))
        heads = np.flatnonzero(opens)
        run = np.cumsum(opens) - 1
        several = batch.column("several").to_numpy(zero_copy_only=False)
        met = np.logical_or.reduceat(several, heads) | (np.diff(np.append(heads, len(name))) > 1)
        # A head from an earlier batch that was told already has no windows left to tell.
        yield from self._whole(batch, np.flatnonzero(met[run] & (batch.column("windows").to_numpy() > 0)))
        batch = batch.take(pa.array(heads))
        windows = np.where(met, 0, batch.column("windows").to_numpy()).astype(np.int32)
        batch = batch.set_column(batch.schema.get_field_index("windows"), "windows", pa.array(windows))
        batch = batch.set_column(batch.schema.get_field_index("several"), "several", pa.array(met))
        closed = int(np.searchsorted(batch.column("name").to_numpy(), name[-1], side="left"))
        self.open = batch.slice(closed)
        yield from self._wait(batch.slice(0, closed))

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.open is not None:
            yield from self._wait(self.open)
        for kind in list(self.waiting):
            yield from self._judge(kind)

    def _wait(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Segments of names with several, until there are enough for a round."""
        name = batch.column("name").to_numpy()
        usable = batch.column("kind").to_numpy() == _SEGMENT
        alone = np.ones(len(name), dtype=bool)
        alone[1:] &= name[1:] != name[:-1]
        alone[:-1] &= name[1:] != name[:-1]
        some = batch.take(pa.array(np.flatnonzero(usable & ~alone)))
        if some.num_rows:
            names = some.column("name").to_numpy()
            borders = np.concatenate(([0], np.flatnonzero(names[1:] != names[:-1]) + 1, [len(names)]))
            ends = np.append(0, np.cumsum(pc.binary_length(some.column("content")).to_numpy().astype(np.int64)))
            sizes = np.diff(ends[borders])
            kinds = np.frexp(sizes.astype(np.float64))[1] >> CLASS_BITS
            for kind in np.unique(kinds).tolist():
                own = np.flatnonzero(kinds == kind)
                rows = np.concatenate([np.arange(borders[i], borders[i + 1]) for i in own.tolist()])
                self.waiting.setdefault(kind, []).append(some.take(pa.array(rows)))
                self.size[kind] = self.size.get(kind, 0) + int(sizes[own].sum())
                if self.size[kind] > STEP_BYTES:
                    yield from self._judge(kind)

    def _judge(self, kind: int) -> Iterator[pa.RecordBatch]:
        """The waiting shards of one class, a round at a time."""
        batch = pa.concat_batches(self.waiting.pop(kind))
        self.size[kind] = 0
        name = batch.column("name").to_numpy()
        borders = np.concatenate(([0], np.flatnonzero(name[1:] != name[:-1]) + 1, [len(name)]))
        ends = np.append(0, np.cumsum(pc.binary_length(batch.column("content")).to_numpy().astype(np.int64)))[borders]
        start = 0
        while start < len(borders) - 1:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + STEP_BYTES, side="right")) - 1)
            yield from self._round(batch.slice(borders[start], borders[stop] - borders[start]))
            start = stop

    def _round(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        contents = [np.frombuffer(x, dtype=np.uint8) for x in batch.column("content").to_pylist()]
        name = batch.column("name").to_numpy()
        shards = np.cumsum(np.concatenate(([True], name[1:] != name[:-1]))) - 1
        t1, t2, place, windows = (batch.column(c).to_numpy() for c in ("t1", "t2", "place", "windows"))
        rows, begins, lengths = [], [], []
        for i, flags in enumerate(repeated_windows(contents, shards, self.window)):
            # What was told as a whole needs no more.
            if windows[i]:
                start, length = _stretches(flags)
                rows += [i] * len(start)
                begins.append(start)
                lengths.append(length)
        if rows:
            at = np.array(rows)
            yield _spans(t1[at], t2[at], place[at] + np.concatenate(begins), np.concatenate(lengths) + self.window - 1)

    def _whole(self, batch: pa.RecordBatch, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(at):
            t1, t2, place, windows = (batch.column(c).to_numpy()[at] for c in ("t1", "t2", "place", "windows"))
            yield _spans(t1, t2, place, windows.astype(np.int64) + self.window - 1)


def _spans(t1: np.ndarray, t2: np.ndarray, place: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(t1), pa.array(t2), pa.array(place), pa.array(length)], names=["t1", "t2", "place", "length"]
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text without its spans."""
    for batch in batches:
        data, places = text_bytes(batch.column(1))
        kept, removed = [], []
        for row, spans in enumerate(batch.column(2)):
            text = data[places[row] : places[row + 1]]
            if not spans.is_valid:
                kept.append(text.tobytes())
                removed.append([])
                continue
            found = spans.values
            start, length = (found.field(c).to_numpy() for c in ("place", "length"))
            edge = np.zeros(len(text) + 1, dtype=np.int64)
            np.add.at(edge, start, 1)
            np.subtract.at(edge, start + length, 1)
            gone = np.cumsum(edge[:-1]) > 0
            kept.append(text[~gone].tobytes())
            removed.append([{"place": int(p), "length": int(n)} for p, n in zip(*_stretches(gone))])
        kind = pa.list_(pa.struct([("place", pa.int64()), ("length", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(kept, pa.binary()), pa.array(np.diff(places)), pa.array(removed, kind)],
            names=["key", "text", "kept", "n_bytes", "removed"],
        )
