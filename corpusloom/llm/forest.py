"""Approximate nearest neighbours by a forest of random-projection trees (operator 6).

Each tree halves the space again and again by a random direction at the median of a bounded sample.
Every vector is put into its leaf of every tree. A query descends all trees through one priority
queue: the next leaf is, of all trees, the one whose way there crossed the nearest cuts. The leaves it
opens are joined with their vectors and all of these are scored exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.hashing import SAMPLE_RANGE, sample_share
from corpusloom.llm.shipping import ship
from corpusloom.sources.store import stage

CHUNK_ROWS = 1_024
QUERY_ROWS = 1_024
PROBES = 64
#: Values of a chunk of vectors at most; hits that a task holds before it cuts them to k a query.
CHUNK_VALUES = 1 << 20
HELD_HITS = 1 << 20


@dataclass(frozen=True)
class Forest:
    """Full binary trees in heap order: ``normals`` (trees, nodes, dimension), ``cuts`` (trees, nodes)."""

    normals: np.ndarray
    cuts: np.ndarray
    depth: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of each row in each tree."""
        out = np.empty((len(x), len(self.normals)), dtype=np.int64)
        for t in range(len(self.normals)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", x, self.normals[t][node]) > self.cuts[t][node]
                node = 2 * node + 1 + side
            out[:, t] = node - ((1 << self.depth) - 1)
        return out

    def search(self, q: np.ndarray, n_leaves: int) -> list[tuple[int, int]]:
        """The (tree, leaf) pairs that one queue over all trees opens first."""
        margins = (self.normals @ q - self.cuts).tolist()
        first_leaf = (1 << self.depth) - 1
        queue = [(0.0, t, 0) for t in range(len(self.normals))]
        found: list[tuple[int, int]] = []
        while queue and len(found) < n_leaves:
            loss, tree, node = heapq.heappop(queue)
            row = margins[tree]
            while node < first_leaf:
                margin = row[node]
                near = 2 * node + 1 + (margin > 0)
                heapq.heappush(queue, (max(loss, abs(margin)), tree, 4 * node + 3 - near))
                node = near
            found.append((tree, node - first_leaf))
        return found


def grow(sample: np.ndarray, trees: int, depth: int, seed: int = 11) -> Forest:
    """Each node projects on the way between two random vectors of its sample, cut at the median."""
    random = np.random.default_rng(seed)
    nodes = (1 << depth) - 1
    normals = random.standard_normal((trees, nodes, sample.shape[1])).astype(np.float32)
    cuts = np.zeros((trees, nodes), dtype=np.float32)
    for t in range(trees):
        members = {0: np.arange(len(sample))}
        for node in range(nodes):
            mine = members.pop(node)
            if len(mine) >= 2:
                a, b = sample[random.choice(mine, 2, replace=False)]
                if np.linalg.norm(a - b) > 0:
                    normals[t, node] = a - b
            normals[t, node] /= np.linalg.norm(normals[t, node])
            along = sample[mine] @ normals[t, node]
            cuts[t, node] = np.median(along) if len(mine) else 0.0
            right = along > cuts[t, node]
            members[2 * node + 1], members[2 * node + 2] = mine[~right], mine[right]
    return Forest(normals, cuts, depth)


def usable(vector: str) -> Column:
    """Vectors that take part: not null, not empty, all components finite, not all zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def nearest_neighbours(
    df: DataFrame,
    key: str,
    vector: str,
    is_query: Column,
    k: int = 20,
    trees: int = 8,
    leaf_rows: int = 512,
    recall: float = 0.95,
    sample_rows: int = 16_384,
) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query its ``k`` nearest found, by inner product in
    double precision on the given vectors; ties to the smaller key. All candidates, if fewer.

    How many leaves a query opens is measured, not given: for ``PROBES`` vectors the true neighbours are
    found by a scan, and queries open as many leaves as bring the probes to ``recall`` of them.
    ``sample_rows`` bounds the vectors that the cuts are fitted on (by a hash of key and vector); every vector is
    indexed. Leaves grow with the data beyond ``sample_rows / 8`` of them. A leaf, whatever its size
    (equal vectors share one), is worked on in chunks of ``CHUNK_ROWS`` vectors by ``QUERY_ROWS`` queries.
    Unusable vectors (see :func:`usable`) and null keys take no part; vectors of several lengths, and keys that
    are not whole numbers, are an error. Other columns are not read. Rows that repeat a key are one candidate for each different score, and as queries give
    the neighbours of one of them; a query is not its own neighbour, by key.
    """
    ship(df)
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        raise TypeError(f"keys have to be whole numbers, not {df.schema[key].dataType.simpleString()}")
    # Floats are the same numbers in double precision; anything else is scored as double from the start.
    kind_of = df.schema[vector].dataType.elementType
    element = "float" if isinstance(kind_of, T.FloatType) else "double"
    rows = df.select(
        F.col(key).alias("id"), F.col(vector).cast(f"array<{element}>").alias("v"), is_query.alias("query")
    ).where(usable(vector) & F.col(key).isNotNull())
    hashed = F.pmod(F.xxhash64("id", "v"), F.lit(SAMPLE_RANGE))
    n, least, shortest, dims = rows.agg(F.count(F.lit(1)), F.min(hashed), F.min(F.size("v")), F.max(F.size("v"))).first()
    if shortest != dims:
        raise ValueError(f"vectors have to be of one length; there are some of {shortest} and of {dims}")
    # Equal rows share a hash; the limit holds where they are many.
    sampled = rows.where(hashed < sample_share(n, sample_rows, least)).orderBy("id", hashed).limit(max(1, 2 * sample_rows)).select("v")
    sample = _matrix(sampled.toArrow().column(0).combine_chunks())
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not sample.size:
        return df.sparkSession.createDataFrame([], schema)
    # Longest first step towards inner products: vectors are lengthened to one norm by a last coordinate.
    longest = float(rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]) ** 0.5
    widest = int(np.log2(max(2, len(sample) // 8)))
    depth = min(widest, max(1, int(np.ceil(np.log2(max(2, n / leaf_rows))))))
    forest = grow(_lengthened(sample, longest), trees, depth)
    query_leaves = _leaves_for(rows, forest, longest, k, recall)
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            x = _lengthened(_matrix(batch.column(1)), longest)
            leaf = forest.leaves(x)
            for t in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, dtype=np.int32)), pa.array(leaf[:, t]), batch.column(0), batch.column(1)],
                    names=["tree", "leaf", "id", "v"],
                )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                x = _matrix(batch.column(1))
                asked = np.concatenate((x, np.zeros((len(x), 1), dtype=np.float32)), axis=1)
                opened = [forest.search(q, query_leaves) for q in asked]
                which = np.repeat(np.arange(len(x)), [len(o) for o in opened])
                pairs = np.array([p for o in opened for p in o], dtype=np.int64).reshape(-1, 2)
                taken = batch.take(pa.array(which))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0].astype(np.int32)), pa.array(pairs[:, 1]), taken.column(0), taken.column(1)],
                    names=["tree", "leaf", "id", "v"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    placed = f"tree int, leaf bigint, id {kind}, v array<{element}>"
    within = max(1, CHUNK_VALUES // (dims or 1))
    # Chunks by a hash of key and row number, so a repeated key is spread: as many as the leaf's count
    # needs. Leaves are a bounded number.
    def chunked(found: DataFrame, size: int, name: str) -> DataFrame:
        found = stage(found, name)
        counts = found.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / size).alias("chunks"))
        counts = stage(counts.withColumnsRenamed({"tree": "c_tree", "leaf": "c_leaf"}), f"{name}-counts")
        met = (F.col("tree") == F.col("c_tree")) & (F.col("leaf") == F.col("c_leaf"))
        # At most trees * 2^depth rows, which the sample bounds.
        chunk = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.col("chunks")).alias("chunk")
        return (
            found.join(F.broadcast(counts), met)
            .select("tree", "leaf", chunk, F.struct("id", "v").alias("x"))
            .groupBy("tree", "leaf", "chunk")
            .agg(F.collect_list("x").alias("x"))
            .select("tree", "leaf", "chunk", F.col("x.id").alias("ids"), F.flatten("x.v").alias("flat"))
        )

    held = chunked(rows.select("id", "v").mapInArrow(place, placed), min(CHUNK_ROWS, within), "leaves")
    asked = chunked(rows.where("query").select("id", "v").mapInArrow(ask, placed), min(QUERY_ROWS, within), "asked")
    met = held.drop("chunk").join(
        asked.select("tree", "leaf", F.col("ids").alias("q_ids"), F.col("flat").alias("q_flat")), ["tree", "leaf"]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for i in range(batch.num_rows):
                ids, flat, q_ids, q_flat = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (2, 3, 4, 5))
                x = flat.astype(np.float64).reshape(len(ids), -1)
                q = q_flat.astype(np.float64).reshape(len(q_ids), -1)
                order = np.argsort(ids, kind="stable")
                ids, x = ids[order], x[order]
                for start in range(0, len(q), 128):
                    some = slice(start, start + 128)
                    held.append(_best(q_ids[some], q[some], ids, x, k))
                if sum(h.num_rows for h in held) > HELD_HITS:
                    held = [_k_best(held, k)]
                    if held[0].num_rows > HELD_HITS // 2:
                        # Very many queries: theirs go on, and the task begins anew.
                        yield held.pop()
        if held:
            yield _k_best(held, k)

    hits = met.mapInArrow(score, "query_id bigint, vec_id bigint, score double")
    # Each task sends k hits for a query, however many leaves of it the task met; then the k best of them.
    rank = F.dense_rank().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = hits.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score").distinct()


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the order of the components wherever a pair meets."""
    total = np.zeros((len(q), len(x)))
    for d in range(q.shape[1]):
        total += np.multiply.outer(q[:, d], x[:, d])
    return total


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best of a chunk (sorted by id) for each query, ties to the smaller id."""
    score = exact_products(q, x)
    score[q_ids[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k:
        least = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k]
        chosen = score > least
        tied = score == least
        chosen |= tied & (np.cumsum(tied, axis=1) <= k - chosen.sum(axis=1, keepdims=True))
    else:
        chosen = np.ones_like(score, dtype=bool)
    row, column = np.nonzero(chosen & np.isfinite(score))
    return pa.RecordBatch.from_arrays(
        [pa.array(q_ids[row].astype(np.int64)), pa.array(ids[column].astype(np.int64)), pa.array(score[row, column])],
        names=["query_id", "vec_id", "score"],
    )


def _k_best(found: list[pa.RecordBatch], k: int) -> pa.RecordBatch:
    """The k best hits of each query, ties to the smaller id; a hit that several trees found counts once."""
    batch = pa.concat_batches(found)
    query, ids, score = (batch.column(c).to_numpy() for c in range(3))
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    again = (query[1:] == query[:-1]) & (ids[1:] == ids[:-1]) & (score[1:] == score[:-1])
    order = order[np.concatenate(([True], ~again))[: len(order)]]
    query = batch.column(0).to_numpy()[order]
    opens = np.concatenate(([True], query[1:] != query[:-1]))[: len(query)]
    place = np.arange(len(query)) - np.maximum.accumulate(np.where(opens, np.arange(len(query)), 0))
    return batch.take(pa.array(order[place < k]))


def _leaves_for(rows: DataFrame, forest: Forest, norm: float, k: int, recall: float) -> int:
    """How many leaves bring the probes to ``recall`` of their true neighbours, found by a scan."""
    probes = rows.orderBy(F.xxhash64("id"), "id").select("id", "v").limit(PROBES).toArrow()
    p_ids = probes.column(0).to_numpy()
    p = _matrix(probes.column(1).combine_chunks())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            order = np.argsort(ids, kind="stable")
            found = _best(p_ids, p.astype(np.float64), ids[order], x[order].astype(np.float64), k)
            place = order[np.searchsorted(ids[order], found.column(1).to_numpy())]
            leaf = forest_.value.leaves(_lengthened(x, norm))[place]
            yield pa.RecordBatch.from_arrays(
                [*found.columns, pa.array(list(leaf))], names=["query_id", "vec_id", "score", "leaves"]
            )

    forest_ = rows.sparkSession.sparkContext.broadcast(forest)
    found = rows.select("id", "v").mapInArrow(scan, "query_id bigint, vec_id bigint, score double, leaves array<bigint>")
    entry = F.struct((-F.col("score")).alias("minus"), "vec_id", "leaves")
    # Each batch brings at most k for each probe: a small share of the rows.
    true = found.groupBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(64))).agg(F.slice(F.array_sort(F.collect_set(entry)), 1, k).alias("b"))
    true = true.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("b"))), 1, k).alias("b"))
    needed: list[int] = []
    asked = dict(zip(p_ids.tolist(), np.concatenate((p, np.zeros((len(p), 1), np.float32)), axis=1)))
    for query, best in true.collect():
        opened = {pair: i for i, pair in enumerate(forest.search(asked[query], forest.cuts.size + len(forest.cuts)))}
        for hit in best:
            needed.append(1 + min(opened[t, leaf] for t, leaf in enumerate(hit["leaves"])))
    if not needed:
        return 1
    return sorted(needed)[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]


def _lengthened(x: np.ndarray, norm: float) -> np.ndarray:
    """Rows with a last coordinate that brings each to ``norm``: the nearest then have the largest products."""
    rest = np.sqrt(np.maximum(norm**2 - np.einsum("ij,ij->i", x, x, dtype=np.float64), 0)).astype(np.float32)
    return np.concatenate((x, rest[:, None]), axis=1)
