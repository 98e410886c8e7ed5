"""A filter of keys of fixed size, which spares rows without a partner the way through a join.

It may let rows without a partner pass, ever more of them as more keys fill it, but holds back none
that has one. Joins behind it are right whatever it lets pass, and without use it costs its fixed size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.hashing import mix
from corpusloom.llm.shipping import ship

BITS = 1 << 24
HASHES = 3


def _places(keys: np.ndarray) -> list[np.ndarray]:
    hashed = mix(keys.astype(np.int64).view(np.uint64))
    return [(hashed >> np.uint64(20 * i)) & np.uint64(BITS - 1) for i in range(HASHES)]


def key_filter(keys: DataFrame, key: str):
    """A function from a bigint column to a boolean one: whether the key may be among ``keys``.

    The bits are set and joined up on the executors; the driver gets BITS / 64 rows at most.
    """
    ship(keys)

    @F.arrow_udf("array<bigint>")
    def bits(values: pa.Array) -> pa.Array:
        places = np.stack(_places(values.to_numpy()), axis=1).astype(np.int64)
        starts = np.arange(len(values) + 1, dtype=np.int32) * HASHES
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(places.ravel()))

    bit = keys.where(F.col(key).isNotNull()).select(F.explode(bits(F.col(key))).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % 64).cast("int"))).alias("set")
    )
    table = words.toArrow()
    filled = np.zeros(BITS // 64, dtype=np.uint64)
    filled[table["word"].to_numpy()] = table["set"].to_numpy().view(np.uint64)
    shared = keys.sparkSession.sparkContext.broadcast(filled)

    @F.arrow_udf("boolean")
    def contains(values: pa.Array) -> pa.Array:
        known = shared.value
        # Null keys have no partner.
        plain = values.fill_null(0).to_numpy().astype(np.int64)
        hit = values.is_valid().to_numpy(zero_copy_only=False)
        for place in _places(plain):
            hit = hit & ((known[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
        return pa.array(hit)

    def may(column: str) -> Column:
        return contains(F.col(column))

    return may
