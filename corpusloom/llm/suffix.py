"""Suffix arrays of many texts at once by induced sorting, and their permuted common prefixes.

A suffix is small or large by its first two code units; a leftmost small one has a large one before it. The
substrings between leftmost small places are sorted and named, the sequence of names is sorted by the same
steps, and from the sorted leftmost small places all other suffixes are induced in one walk up and one
walk down. The walks of all texts go in step: step t handles entry t of every text, so their arrays are one
numpy array and each step a few operations on as many values as there are texts that long.
"""

from __future__ import annotations

import numpy as np


def dense(keys: np.ndarray, n_keys: int) -> np.ndarray:
    """The rank of each key among the keys that occur."""
    there = np.zeros(n_keys, dtype=bool)
    there[keys] = True
    return (np.cumsum(there, dtype=np.int64) - 1)[keys]


def suffix_arrays(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The suffixes of each text in order, from the text's start on, as places in ``symbols``.

    ``symbols`` holds texts one after the other, from ``starts``: dense ranks, those of a text above those of the
    text before. The last symbol of a text is its smallest, and there only.
    """
    n = len(symbols)
    ends = np.append(starts[1:], n)
    run_ends = np.flatnonzero(np.append(symbols[1:] != symbols[:-1], True))
    rises = np.append(symbols[run_ends[:-1] + 1] > symbols[run_ends[:-1]], True)
    small = np.repeat(rises, np.diff(np.append(-1, run_ends)))
    leftmost = np.zeros(n, dtype=bool)
    leftmost[1:] = small[1:] & ~small[:-1]
    marks = np.flatnonzero(leftmost)
    walk = _Walk(symbols, starts, ends, small)

    # Sorted by their substrings first: any order within a bucket will do.
    order = walk.induce(marks[np.argsort(symbols[marks], kind="stable")])
    order = order[leftmost[order]]
    names, at = _names(symbols, marks, order, ends)
    text = np.repeat(np.arange(len(starts)), ends - starts)[marks]
    marks_of, names_of = np.bincount(text, minlength=len(starts)), np.zeros(len(starts), dtype=np.int64)
    some = np.flatnonzero(marks_of)
    last = np.cumsum(marks_of)[some]
    names_of[some] = names[at][last - 1] - np.append(-1, names[at][last[:-1] - 1])
    # Texts with a name twice are sorted by their names in the same way.
    again = (names_of < marks_of)[text]
    if again.any():
        inner = np.flatnonzero(again)
        sizes = marks_of[names_of < marks_of]
        found = suffix_arrays(dense(names[inner], len(marks)), np.cumsum(sizes) - sizes)
        order[again[at]] = marks[inner[found]]
    return walk.induce(order)


def _names(symbols: np.ndarray, marks: np.ndarray, order: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(name of each mark in text order, which mark each of ``order`` is): equal substrings have equal names,
    which rise in the order of the substrings."""
    lengths = np.append(np.diff(marks) + 1, 1)
    lengths[np.isin(marks, ends - 1, assume_unique=True)] = 1
    number = np.zeros(len(symbols), dtype=np.int64)
    number[marks] = np.arange(len(marks))
    at = number[order]
    size = lengths[at]
    differs = np.ones(len(order), dtype=bool)
    same = 1 + np.flatnonzero(size[1:] == size[:-1])
    depth = 0
    while len(same):
        same = same[symbols[order[same] + depth] == symbols[order[same - 1] + depth]]
        depth += 1
        over = size[same] == depth
        differs[same[over]] = False
        same = same[~over]
    names = np.empty(len(order), dtype=np.int64)
    names[at] = np.cumsum(differs) - 1
    return names, at


class _Walk:
    """The two walks over the entries of all texts, in step."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, small: np.ndarray) -> None:
        n = len(symbols)
        self.symbols, self.starts, self.ends = symbols, starts, ends
        counts = np.bincount(symbols)
        self.bucket_ends = np.cumsum(counts)
        self.bucket_starts = self.bucket_ends - counts
        by_size = np.argsort(starts - ends, kind="stable")
        self.first, self.last = starts[by_size], ends[by_size] - 1
        sizes = (ends - starts)[by_size]
        #: How many texts have more than t entries.
        self.width = len(sizes) - np.searchsorted(sizes[::-1], np.arange(int(sizes[0])), side="right")
        # Of the suffix one to the left; the entry behind the last stands for "none".
        before = np.zeros(n + 1, dtype=bool)
        before[1:n] = True
        before[starts] = False
        self.large_before, self.small_before = before.copy(), before
        self.large_before[1:n] &= ~small[:-1]
        self.small_before[1:n] &= small[:-1]

    def induce(self, marks: np.ndarray) -> np.ndarray:
        """All suffixes in order, from the leftmost small ones in order of their first symbols at least."""
        symbols, n = self.symbols, len(self.symbols)
        entries = np.full(n, -1, dtype=np.int64)
        bucket = symbols[marks]
        # Of each bucket, as many of the last places as it has marks.
        until = np.cumsum(np.bincount(bucket, minlength=len(self.bucket_ends)))[bucket]
        entries[self.bucket_ends[bucket] - until + np.arange(len(marks))] = marks
        entries[self.starts] = self.ends - 1
        head, tail = self.bucket_starts.copy(), self.bucket_ends - 1
        for t, width in enumerate(self.width.tolist()):
            found = entries[self.first[:width] + t]
            found = found[self.large_before[found]] - 1
            into = symbols[found]
            place = head[into]
            entries[place] = found
            head[into] = place + 1
        for t, width in enumerate(self.width.tolist()):
            found = entries[self.last[:width] - t]
            found = found[self.small_before[found]] - 1
            into = symbols[found]
            place = tail[into]
            entries[place] = found
            tail[into] = place - 1
        return entries


def common_prefixes(units: np.ndarray, starts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(common prefix with the suffix before in order, that suffix) of each place, in text order.

    ``units`` are bytes, of which the last of a text is there only once. Where the bytes before both suffixes are equal the
    value is that of the place before less one; only the others are compared, eight bytes at a time.
    """
    n = len(order)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    before[order[starts]] = -1
    opens = np.zeros(n, dtype=bool)
    opens[starts] = True
    known = before >= 0
    own = ~known | opens | opens[np.maximum(before, 0)]
    inner = np.flatnonzero(~own)
    own[inner[units[inner - 1] != units[before[inner] - 1]]] = True
    at = np.flatnonzero(own & known)
    padded = np.append(units, np.zeros(8, dtype=np.uint8))
    eight = np.ndarray(shape=(n,), dtype="<u8", buffer=padded, strides=(1,))
    value = np.zeros(n, dtype=np.int64)
    depth = 0
    while len(at):
        other = eight[at + depth] ^ eight[before[at] + depth]
        parted = np.flatnonzero(other)
        lowest = other[parted] & (~other[parted] + np.uint64(1))
        value[at[parted]] = depth + ((np.frexp(lowest.astype(np.float64))[1] - 1) >> 3)
        at = at[other == 0]
        depth += 8
    last = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return value[last] - (np.arange(n) - last), before
