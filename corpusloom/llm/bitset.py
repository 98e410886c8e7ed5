"""Bit sets over hash places: filled on the executors, of a size fixed beforehand, tested in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bits_for(items: int, each: int, least: int, most: int) -> int:
    """The power of two with ``each`` places an item, between two bounds."""
    return min(most, max(least, (max(items, 1) * each - 1).bit_length()))


def place_of(hashed: Column, bits: int) -> Column:
    """The first ``bits`` bits of a 64-bit hash."""
    return F.call_function("shiftrightunsigned", hashed, F.lit(64 - bits))


def places_of(hashed: np.ndarray, bits: int) -> np.ndarray:
    """:func:`place_of` of an array of 64-bit hashes."""
    return hashed.view(np.uint64) >> np.uint64(64 - bits)


def collect_bits(places: DataFrame, place: str, bits: int) -> np.ndarray:
    """A set with every place of the column. Words of 64 places are joined up on the executors; the
    driver gets 2^bits / 64 rows at most."""
    words = places.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col(place) % 64).cast("int"))).alias("set")
    )
    table = words.toArrow()
    filled = np.zeros((1 << bits) // 64, dtype=np.uint64)
    filled[table["word"].to_numpy()] = table["set"].to_numpy().view(np.uint64)
    return filled


def holds(filled: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((filled[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)).astype(bool)
