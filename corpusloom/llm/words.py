"""Whitespace words of whole texts in Arrow columns, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Work on the words of a slice takes some twenty times its bytes.
SLICE_BYTES = 2 << 20


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of ``batch`` with about ``limit`` bytes of text, one row at least."""
    sizes = np.nan_to_num(
        pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.float64)
    )
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0.0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: (words per row, index of each word, distinct words).

    Null texts have no words. Words keep their order; the index points into the distinct ones.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    index = coded.indices.to_numpy()
    counts = np.diff(offsets).astype(np.int64)
    # Blank rims give empty words; they are no words.
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if empty >= 0:
        real = index != empty
        ends = np.concatenate(([0], np.cumsum(real)))[offsets - offsets[0]]
        counts = np.diff(ends)
        index = index[real]
    return counts, index, coded.dictionary
