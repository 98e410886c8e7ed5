"""Joining texts of similar word shingles by banded MinHash LSH (operator 5).

Each band ("tree") has its own run of minimum hashes, and texts whose runs are equal in some band meet. All
runs have one length, fixed before any data are read: the longest at which the chance that two texts
of the threshold's similarity meet in some band reaches the target recall. This is not an LSH
forest: prefixes are not shortened by what the data show.

Texts that meet are connected into candidate groups; inside a group every pair is compared exactly, on
whole shingle sets, in blocks of a bounded number of texts, so neither a bucket nor a group is ever in one
task, and pairs are counted where they are compared instead of being written out. Equal word
sequences are collapsed to a class before; only one of each class is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.hashing import SpanHashes, mix, word_hashes
from corpusloom.llm.shipping import ship
from corpusloom.llm.words import split_words, text_slices
from corpusloom.llm.workers import released
from corpusloom.sources.store import drop_staged, stage

TREES, DEPTH = 32, 8
BLOCK_TEXTS = 256
SALTS = 32
SLICE_BYTES = 4 << 20


def prefix_length(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest run at which a pair of ``threshold`` similarity meets with ``recall``, by formula."""
    length = depth
    while length > 1 and 1 - (1 - threshold**length) ** trees < recall:
        length -= 1
    return length


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, hash of each shingle, first shingle of each text).

    Shingles are runs of ``width`` words, repeats included; a shorter text is one shingle, a text
    without words has none.
    """
    counts, index, distinct = split_words(texts)
    spans = SpanHashes(word_hashes(distinct)[index] if len(index) else np.zeros(0, np.uint64))
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    firsts = np.cumsum(n) - n
    starts = np.repeat(np.cumsum(counts) - counts - firsts, n) + np.arange(n.sum())
    ends = starts + np.repeat(np.minimum(counts, width), n)
    return counts, spans.of(starts, ends), firsts


def forest_keys(hashes: np.ndarray, firsts: np.ndarray, n: int, trees: int, length: int) -> np.ndarray:
    """Key of each text (with shingles) in each tree: its minimum hashes under ``length`` permutations."""
    random = np.random.default_rng(5)
    odd = random.integers(1, 1 << 32, size=(trees, DEPTH), dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    add = random.integers(0, 1 << 32, size=(trees, DEPTH), dtype=np.uint64).astype(np.uint32)
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    keys = np.empty((n, trees), dtype=np.uint64)
    for t in range(trees):
        key = np.full(n, t, dtype=np.uint64)
        for d in range(length):
            value = (low ^ (low >> np.uint32(15))) * odd[t, d] + add[t, d]
            value ^= value >> np.uint32(16)
            value *= np.uint32(0x85EBCA6B)
            key = mix(key + np.minimum.reduceat(value, firsts).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        keys[:, t] = key
    return keys


def similar_pairs(sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of sets whose Jaccard similarity reaches ``threshold``, counted exactly."""
    sizes = np.array([len(s) for s in sets])
    _, name = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(name, kind="stable")
    posting = owner[order]
    first = np.concatenate(([0], np.cumsum(np.bincount(name))))
    ends = np.cumsum(sizes)
    left, right = [], []
    for i in range(len(sets)):
        mine = name[ends[i] - sizes[i] : ends[i]]
        length = first[mine + 1] - first[mine]
        at = np.repeat(first[mine] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        shared = np.bincount(posting[at], minlength=len(sets))[i + 1 :]
        # shared / (a + b - shared) >= threshold
        near = np.flatnonzero(shared >= threshold * (sizes[i] + sizes[i + 1 :] - shared) - 1e-9)
        left.append(np.full(len(near), i))
        right.append(near + i + 1)
    return np.concatenate(left), np.concatenate(right)


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index connected with each."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, left, root[right])
        np.minimum.at(least, right, root[left])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def near_duplicates(
    df: DataFrame,
    key: str,
    text: str,
    threshold: float = 0.8,
    width: int = 5,
    recall: float = 0.9999,
) -> DataFrame:
    """(key, class_id, n_links) for every row: the smallest key of its class, and its number of links.

    Two rows are linked if their sets of ``width``-word shingles have Jaccard similarity of
    ``threshold`` or more; a class is what links connect. Texts of fewer words are one shingle; null
    texts and texts without words are linked to nothing. Rows that repeat key and text are
    linked like any equal texts. Rows with a null key, or a key that several texts have, are members
    like others, by their text; a class of null keys alone has the class id null. Other columns are not read.
    """
    ship(df)
    length = prefix_length(threshold, recall)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                counts, hashes, firsts = shingles(part.column(1), width)
                some = np.flatnonzero(counts > 0)
                node = _nodes(part.column(1))
                keys = np.zeros((0, TREES), np.uint64)
                if len(some):
                    keys = forest_keys(hashes, firsts[some], len(some), TREES, length)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), node, pa.array(_spread(keys, some, part.num_rows), pa.list_(pa.int64()))],
                    names=["key", "h", "node", "trees"],
                )

    signed = stage(rows.mapInArrow(released(sign), f"key {kind}, h bigint, node bigint, trees array<bigint>"), "signatures")
    classes = signed.where("node is not null").groupBy("node").agg(
        F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"), F.coalesce(F.min_by("h", "key"), F.min("h")).alias("w_h")
    )
    classes = stage(classes, "classes")
    trees = signed.where("node is not null").groupBy("node").agg(F.first("trees").alias("trees"))
    met = trees.select("node", F.explode("trees").alias("bucket"))
    shared = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    # Spark takes an exploded table for no larger than before, and would broadcast it.
    groups = components(met.hint("merge").join(shared, "bucket"), "node", "bucket")

    # A group's texts go to blocks, and every pair of blocks to a task with both.
    sizes = stage(groups.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).alias("blocks")), "group-sizes")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    placed = stage(groups.join(sizes, "label").select("node", "label", "blocks", block), "placed")
    # A class's text comes back by the key and the text hash of one of its rows, so a key that many
    # rows have meets only the rows that hold the text; equal rows become one before they are read.
    wanted = placed.join(classes.select("node", "least", "w_h", "copies"), "node")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                counts, hashes, firsts = shingles(part.column("text"), width)
                node = _nodes(part.column("text"))
                ends = np.append(firsts[1:], len(hashes))
                content = [np.unique(hashes[s:e]).tobytes() for s, e in zip(firsts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [node, pa.array(content, pa.binary()), *(part.column(c) for c in ("w_node", "label", "blocks", "block", "copies"))],
                    names=["node", "content", "w_node", "label", "blocks", "block", "copies"],
                )

    held = rows.where("text is not null").join(
        wanted.withColumnRenamed("node", "w_node"), (F.col("h") == F.col("w_h")) & F.col("key").eqNullSafe(F.col("least"))
    )
    held = held.select("text", "w_node", "label", "blocks", "block", "copies").distinct()
    content = held.mapInArrow(
        sets, "node bigint, content binary, w_node bigint, label bigint, blocks bigint, block bigint, copies bigint"
    ).where("node = w_node").dropDuplicates(["node"])
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    paired = content.select("*", other.alias("other")).select(
        "node", "content", "copies", "label", "block",
        F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sets_ = [np.frombuffer(x, dtype=np.uint64) for x in table["content"].to_pylist()]
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        block, a, b = (table[c].to_numpy() for c in ("block", "a", "b"))
        left, right = similar_pairs(sets_, threshold)
        # Pairs inside one block belong to the task of that block alone.
        own = (a[left] == b[left]) | (block[left] != block[right])
        left, right = left[own], right[own]
        links = np.bincount(left, weights=copies[right], minlength=len(node))
        links += np.bincount(right, weights=copies[left], minlength=len(node))
        root = _roots(len(node), left, right)
        least = np.full(len(node), np.iinfo(np.int64).max)
        np.minimum.at(least, root, node)
        return pa.table({"node": node, "hub": least[root], "links": links.astype(np.int64)})

    found = paired.groupBy("label", "a", "b").applyInArrow(compare, "node bigint, hub bigint, links bigint")
    found = stage(found.where("links > 0"), "links")
    labels = components(found, "node", "hub")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = classes.join(labels, "node", "left").join(counted, "node", "left").select(
        "node", "least", "copies", F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).alias("links")
    )
    nodes = stage(nodes, "nodes")
    least = nodes.groupBy("label").agg(F.min("least").alias("class_id"))
    known = stage(
        nodes.join(least, "label").select(
            F.col("node").alias("k_node"), "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links")
        ),
        "known",
    )
    drop_staged(classes, sizes, placed, found, nodes)
    known = known.withColumn("k_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    # A class may hold a large share of the rows: its rows are spread over salts.
    salted = signed.select("key", "node", F.pmod(F.xxhash64("h", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("salt"))
    out = salted.join(known, (F.col("node") == F.col("k_node")) & (F.col("salt") == F.col("k_salt")), "left")
    return out.select(
        F.col("key").alias(key),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def _nodes(texts: pa.Array) -> pa.Array:
    """A name for each text's word sequence; null without words. A hash of all its words' hashes as bytes: sums
    of powers, which do for a few words, agree by rule on some orders of thousands."""
    counts, index, distinct = split_words(texts)
    hashes = word_hashes(distinct)[index] if len(index) else np.zeros(0, np.uint64)
    ends = np.cumsum(counts)
    spans = zip((ends - counts).tolist(), ends.tolist())
    names = np.fromiter((xxhash.xxh3_64_intdigest(hashes[s:e]) for s, e in spans), dtype=np.uint64, count=len(counts))
    return pa.array(names.astype(np.int64), mask=counts == 0)


def _spread(keys: np.ndarray, some: np.ndarray, n: int) -> list:
    out: list = [None] * n
    for i, row in zip(some.tolist(), keys.astype(np.int64)):
        out[i] = row
    return out
