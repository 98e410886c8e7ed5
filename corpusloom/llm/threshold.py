"""Exact top-k by Fagin's threshold algorithm over sorted per-dimension lists (operator 8).

The vectors lie in blocks. In a block each dimension has a list of the rows sorted by their value
there. A query walks the lists from the end that its own component favours, all to the same depth; every
row met is scored in full, and the values at that depth bound what any row not met can score. The walk
stops when the bound is below the k-th best score so far, or when the block has been met in full.
The k best of every block are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shipping import ship
from corpusloom.sources.store import stage

BLOCK_ROWS = 8_192
QUERY_ROWS = 512
FIRST_DEPTH = 4


class SortedLists:
    """A block's rows (sorted by id, int64) and, for each dimension, their order by value."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.order = np.argsort(self.x, axis=0, kind="stable")
        self.low = np.take_along_axis(self.x, self.order, axis=0)
        self.floats = self.x.astype(np.float64)
        self.largest = int(np.abs(self.x).max(initial=0))

    def products(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products; in floating point as long as no sum can leave its whole numbers."""
        if self.largest * int(np.abs(q).sum()) < 1 << 52:
            return (self.floats[rows] @ q.astype(np.float64)).astype(np.int64)
        return self.x[rows] @ q

    def bound(self, q: np.ndarray, depth: int) -> np.ndarray:
        """For each query, the most that a row beyond ``depth`` in all lists can score."""
        last = len(self.ids) - 1
        high = self.low[max(last - depth, 0)]
        low = self.low[min(depth, last)]
        return np.where(q > 0, q * high, q * low).sum(axis=1)

    def met(self, q: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Rows that stand in some list of one query between two depths."""
        n, dims = len(self.ids), np.flatnonzero(q)
        up = dims[q[dims] > 0]
        down = dims[q[dims] < 0]
        found = np.zeros(n, dtype=bool)
        found[self.order[max(n - stop, 0) : n - start, up].ravel()] = True
        found[self.order[start:stop, down].ravel()] = True
        return found


def threshold_search(
    lists: SortedLists, q_ids: np.ndarray, q: np.ndarray, k: int, best_ids: np.ndarray, best_scores: np.ndarray
) -> None:
    """Improve each query's ``best`` (k columns, best first; the lowest score where there is none yet)."""
    n = len(lists.ids)
    active = np.flatnonzero(lists.bound(q, 0) >= best_scores[:, -1])
    seen = np.zeros((len(q), n), dtype=bool) if len(active) else None
    start, stop = 0, FIRST_DEPTH
    while len(active):
        whole = stop * q.shape[1] >= n
        for i in active:
            new = np.ones(n, dtype=bool) if whole or not q[i].any() else lists.met(q[i], start, stop)
            rows = np.flatnonzero(new & ~seen[i])
            seen[i] |= new
            rows = rows[lists.ids[rows] != q_ids[i]]
            scores = lists.products(rows, q[i])
            better = scores >= best_scores[i, -1]
            ids = np.concatenate((best_ids[i], lists.ids[rows[better]]))
            scores = np.concatenate((best_scores[i], scores[better]))
            top = np.lexsort((ids, ~scores))[:k]
            best_ids[i], best_scores[i] = ids[top], scores[top]
        if whole:
            break
        active = active[lists.bound(q[active], stop) >= best_scores[active, -1]]
        start, stop = stop, stop * 4


def _rows(batch: pa.RecordBatch, ids: int, flat: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    names = batch.column(ids)[i].values.to_numpy(zero_copy_only=False)
    return names, batch.column(flat)[i].values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(names), -1)


def top_products(
    df: DataFrame, key: str, vector: str, is_query: Column, k: int = 5, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest inner product for each query.

    ``vector`` is an array of integers, whose products must fit 64 bits; ties go to the smaller key. A
    query's own key is no candidate; all candidates, if fewer. Rows whose vector is null, empty or
    has a null, and null keys, take no part; rows that repeat a key are candidates each. Every block of
    ``QUERY_ROWS`` queries meets every block of candidates: this is an exact search, the queries are a
    stated set, and only k rows for each pair of blocks and query go on.
    """
    ship(df)
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<bigint>").alias("v"), is_query.alias("query")).where(
        F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull())
    )
    counts = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("query"), 1))).first()
    n_blocks, n_asked = (max(1, -(-c // size)) for c, size in zip(counts, (block_rows, QUERY_ROWS)))

    def blocks(found: DataFrame, n: int) -> DataFrame:
        salt = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n)).alias("block")
        return found.groupBy(salt).agg(F.collect_list(F.struct("id", "v")).alias("x")).select(
            "block", F.col("x.id").alias("ids"), F.flatten("x.v").alias("flat")
        )

    held = stage(blocks(rows.select("id", "v"), n_blocks), "blocks")
    asked = stage(blocks(rows.where("query").select("id", "v"), n_asked), "asked").select(
        F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("flat").alias("q_flat"),
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
    )
    # Spark sizes the queries by their files, as they are before each block gets a copy, and would broadcast them.
    met = asked.hint("merge").join(held, "block").select("ids", "flat", "q_ids", "q_flat", "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, lists = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                ids, x = _rows(batch, 0, 1, i)
                block = batch.column(4)[i].as_py()
                if last != block:
                    lists, last = SortedLists(ids, x), block
                q_ids, q = _rows(batch, 2, 3, i)
                best_ids = np.full((len(q), k), np.iinfo(np.int64).max)
                best = np.full((len(q), k), np.iinfo(np.int64).min)
                threshold_search(lists, q_ids, q, k, best_ids, best)
                row, column = np.nonzero(best != np.iinfo(np.int64).min)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[row].astype(np.int64)), pa.array(best_ids[row, column]), pa.array(best[row, column])],
                    names=["query_id", "vec_id", "score"],
                )

    hits = met.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    # A query has k hits from each block: cut to k inside each task, then for each query, without a list.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
