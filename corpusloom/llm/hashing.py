"""Hashes of words, word sequences and shingles, the same in every task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

FACTOR = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(FACTOR, -1, 1 << 64)
#: Samples by a hash go by its rest of this.
SAMPLE_RANGE = 1 << 62


def sample_share(n: int, bound: int, least: int | None) -> int:
    """Below which hash, of ``SAMPLE_RANGE``, about ``bound`` of ``n`` rows lie. It is above ``least``, the
    smallest hash of the rows, so of some rows a sample has one at any size."""
    share = SAMPLE_RANGE if n <= bound else SAMPLE_RANGE * bound // n
    return max(share, (least or 0) + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(distinct: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), dtype=np.uint64, count=len(distinct))


class SpanHashes:
    """Hash of any span of a sequence of word hashes, from its content alone."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words) + 1
        self.inverse = _powers(INVERSE, n)
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(words * _powers(FACTOR, n)[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


_known: dict[int, np.ndarray] = {}
REMEMBERED_POWERS = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers. Those that a slice of usual size takes are remembered, no more."""
    if n > REMEMBERED_POWERS:
        return _made_powers(base, n)
    if base not in _known:
        _known[base] = _made_powers(base, REMEMBERED_POWERS)
    return _known[base][:n]


def _made_powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers)
