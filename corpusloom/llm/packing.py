"""Vector bin packing of examples into training sequences (operator 1).

An example needs tokens, one segment, and loss-bearing tokens, and a sequence has a limit
for each. The next example to place is the one whose needs have the largest dot product with
what the open sequence has left, both as shares of the limits, among the examples that fit.

Each task packs the rows of its own partition through a bounded pool of waiting examples, so
nothing is shuffled, no key can be hot, and memory does not grow with the partition. A task's
sequences depend on its rows and their order alone: a task that runs again after a lost executor
makes the same ones, as long as the input is a scan or a written table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.encode import encoder
from corpusloom.llm.shipping import ship
from corpusloom.llm.words import text_slices
from corpusloom.llm.workers import released

POOL = 512
SEQUENCE_BITS = 33


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most."""

    tokens: int = 4096
    segments: int = 256
    loss_tokens: int = 4096

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss_tokens) < 1:
            raise ValueError("limits must be positive")


@dataclass
class _Item:
    key: object
    ids: np.ndarray
    loss: np.ndarray | None
    start: int
    total: int

    @property
    def needs(self) -> tuple[int, int, int]:
        left = len(self.ids) - self.start
        return left, 1, left if self.loss is None else int(self.loss[self.start :].sum())

    def fits_until(self, tokens: int, loss_tokens: int) -> int:
        """The longest next piece within both limits."""
        n = min(tokens, len(self.ids) - self.start)
        if self.loss is None:
            return min(n, loss_tokens)
        used = np.cumsum(self.loss[self.start : self.start + n])
        return int(np.searchsorted(used, loss_tokens, side="right"))


class Packer:
    """Places examples; ``add`` and ``flush`` yield (key, start, ids, total, sequence, offset)."""

    def __init__(self, limits: Limits, cut: bool, pool: int = POOL) -> None:
        self.limits, self.cut, self.size = limits, cut, pool
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
        self.items: list[_Item | None] = [None] * pool
        self.needs = np.full((pool, 3), np.inf)
        self.free = list(range(pool))[::-1]
        self.sequence = 0

    def add(self, key, ids: np.ndarray, loss: np.ndarray | None = None) -> Iterator[tuple]:
        item = _Item(key, ids, loss, 0, len(ids))
        if not self.cut and any(n > c for n, c in zip(item.needs, self.caps)):
            raise ValueError(f"example {key!r} needs {item.needs}, beyond {self.limits}; allow cuts")
        while self.cut and any(n > c for n, c in zip(item.needs, self.caps)):
            n = item.fits_until(self.limits.tokens, self.limits.loss_tokens)
            yield from self._close([(item, item.start, n)])
            item.start += n
        if item.start == len(ids) and len(ids):
            return
        slot = self.free.pop()
        self.items[slot] = item
        self.needs[slot] = item.needs
        if not self.free:
            yield from self._fill()

    def flush(self) -> Iterator[tuple]:
        while len(self.free) < self.size:
            yield from self._fill()

    def _fill(self) -> Iterator[tuple]:
        """Open a sequence, fill it from the pool and close it."""
        left = self.caps.copy()
        placed: list[tuple[_Item, int, int]] = []
        while left[0] > 0 and left[1] > 0:
            fits = (self.needs <= left).all(axis=1)
            if not fits.any():
                break
            value = np.where(fits, np.where(np.isinf(self.needs), 0, self.needs) @ (left / self.caps**2), -1)
            slot = int(value.argmax())
            item = self.items[slot]
            placed.append((item, item.start, len(item.ids) - item.start))
            left -= self.needs[slot]
            self._drop(slot)
        if self.cut and left[0] > 0 and left[1] > 0 and left[2] > 0 and len(self.free) < self.size:
            waiting = np.isfinite(self.needs[:, 0])
            value = np.where(waiting, np.where(np.isinf(self.needs), 0, self.needs) @ (left / self.caps**2), -1)
            slot = int(value.argmax())
            item = self.items[slot]
            n = item.fits_until(int(left[0]), int(left[2]))
            if n:
                placed.append((item, item.start, n))
                item.start += n
                self.needs[slot] = item.needs
        yield from self._close(placed)

    def _drop(self, slot: int) -> None:
        self.items[slot] = None
        self.needs[slot] = np.inf
        self.free.append(slot)

    def _close(self, placed: list[tuple[_Item, int, int]]) -> Iterator[tuple]:
        """Number the sequence. One that stays short is cut into powers of two, if cuts are
        allowed, because sequences of such a length are not padded."""
        total = sum(n for _, _, n in placed)
        rooms = [total]
        if self.cut and total < self.limits.tokens:
            rooms = [1 << b for b in reversed(range(total.bit_length())) if total >> b & 1] or [0]
        offset, room = 0, rooms.pop(0)
        for item, start, n in placed:
            end = start + n
            while True:
                take = min(end - start, room - offset)
                yield item.key, start, item.ids[start : start + take], item.total, self.sequence, offset
                start, offset = start + take, offset + take
                if offset == room and rooms:
                    self.sequence, offset, room = self.sequence + 1, 0, rooms.pop(0)
                if start >= end:
                    break
        self.sequence += 1


def _schema(df: DataFrame, key: str) -> str:
    kind = df.schema[key].dataType.simpleString()
    return f"`{key}` {kind}, start bigint, length bigint, ids binary, example_tokens bigint, sequence_id bigint, offset bigint"


def _emit(pieces: list[tuple], base: int, key: str, kind: pa.DataType) -> pa.RecordBatch:
    keys, starts, ids, totals, sequences, offsets = zip(*pieces)
    long = pa.int64()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys, kind),
            pa.array(starts, long),
            pa.array([len(i) for i in ids], long),
            pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
            pa.array(totals, long),
            pa.array([base + s for s in sequences], long),
            pa.array(offsets, long),
        ],
        names=[key, "start", "length", "ids", "example_tokens", "sequence_id", "offset"],
    )


def _run(examples: Iterator[tuple], packer: Packer, key: str, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << SEQUENCE_BITS
    pieces: list[tuple] = []
    held = 0
    for key_, ids, loss in examples:
        for piece in packer.add(key_, ids, loss):
            pieces.append(piece)
            held += len(piece[2]) + 16
            if held > 1 << 19:
                yield _emit(pieces, base, key, kind)
                pieces, held = [], 0
    pieces.extend(packer.flush())
    if pieces:
        yield _emit(pieces, base, key, kind)


def pack_documents(
    df: DataFrame,
    key: str,
    text: str,
    tokenizer_path: str,
    end_id: int,
    limits: Limits = Limits(),
) -> DataFrame:
    """Tokenize whole texts, end each with ``end_id``, and pack them, cutting where a cut fills a gap.

    One row per piece: the key, ``start`` and ``length`` in the example's ids, ``ids`` (unsigned
    32-bit little-endian), ``example_tokens``, ``sequence_id`` and ``offset`` there. Every id counts
    as loss-bearing. Null texts are empty and give one id, as empty ones do; null and repeated
    keys are carried as they are, each row packed on its own; other columns are not read, so
    their names do not matter; an empty table gives no rows. Texts may have any length.
    """

    ship(df)
    kind = _arrow_kind(df, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)

        def examples() -> Iterator[tuple]:
            for batch in batches:
                for part in text_slices(batch, batch.schema.names[1]):
                    offsets, ids = encode.encode(part.column(1), end_id)
                    for i, k in enumerate(part.column(0).to_pylist()):
                        yield k, ids[offsets[i] : offsets[i + 1]].copy(), None

        yield from _run(examples(), Packer(limits, cut=True), key, kind)

    return df.select(key, text).mapInArrow(released(run), _schema(df, key))


def pack_examples(
    df: DataFrame,
    key: str,
    input_ids: str,
    loss_mask: str | None = None,
    limits: Limits = Limits(),
    cut: bool = False,
) -> DataFrame:
    """Pack tokenized instruction examples; rows as those of :func:`pack_documents`.

    ``loss_mask`` (0 or 1 per id) says which ids bear loss; without it all do. Examples stay
    whole unless ``cut``; one beyond a limit is then an error. Null ids are an empty example,
    which takes a segment; a null mask, or one that is too short, bears no loss where it has no value.
    """
    ship(df)
    kind = _arrow_kind(df, key)
    columns = [key, input_ids] + ([loss_mask] if loss_mask else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def examples() -> Iterator[tuple]:
            for batch in batches:
                masks = batch.column(2).to_pylist() if loss_mask else [None] * batch.num_rows
                for k, ids, mask in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), masks):
                    ids = np.array(ids or [], dtype=np.int64)
                    loss = None
                    if loss_mask:
                        loss = np.zeros(len(ids), dtype=np.int64)
                        given = [1 if m else 0 for m in (mask or [])][: len(ids)]
                        loss[: len(given)] = given
                    yield k, ids, loss

        yield from _run(examples(), Packer(limits, cut), key, kind)

    return df.select(*columns).mapInArrow(released(run), _schema(df, key))


def _arrow_kind(df: DataFrame, key: str) -> pa.DataType:
    return to_arrow_type(df.schema[key].dataType)


def with_crc32(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of the ids themselves."""
    return pieces.withColumn("ids_crc32", F.crc32("ids").cast("bigint")).drop("ids")
