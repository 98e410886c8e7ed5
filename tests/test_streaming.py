"""Streamed packing against packing of the whole table, over triggers, restarts and failures."""

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.packing import pack
from corpusloom.queries import tables as t
from corpusloom.queries.scans import R
from corpusloom.streaming.packing import open_blocks, pack_stream
from corpusloom.streaming.source import drain_to_parquet, stream_source

SCHEMA = "source string, k bigint, input_ids array<int>, widths array<string>"


def rows_of(n, seed=1, sources=("a", "b", None)):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        ids = [rng.randrange(100) for _ in range(rng.choice([0, 1, 3, 30, 7]))]
        rows.append((rng.choice(sources), k, None if k % 17 == 5 else ids, None if k % 17 == 5 else [str(x) for x in ids]))
    return rows


def arrive(spark, root, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/in/{name}")


def drain(spark, root, seq_len, batch_rows, columns, files=None, change=lambda df: df):
    stream = change(stream_source(spark, f"{root}/in", "parquet", SCHEMA, max_files_per_trigger=files))
    blocks = pack_stream(stream, ["source"], "k", seq_len, batch_rows, columns)
    drain_to_parquet(blocks, f"{root}/blocks", f"{root}/progress")
    return blocks.schema


def streamed(spark, root, schema, seq_len, columns):
    full = spark.read.schema(schema).parquet(f"{root}/blocks")
    every = full.unionByName(open_blocks(spark, f"{root}/progress", seq_len, columns)).collect()
    found = {(r.source, r.batch_id, r.block_id): [list(r[c]) for c in columns] for r in every}
    assert len(found) == len(every)
    return found


def whole(spark, rows, seq_len, batch_rows, columns):
    out = {}
    df = spark.createDataFrame(rows, SCHEMA)
    for source in {r[0] for r in rows}:
        for r in pack(df.where(F.col("source").eqNullSafe(source)), "k", seq_len, batch_rows, columns).collect():
            out[source, r.batch_id, r.block_id] = [list(r[c]) for c in columns]
    return out


@pytest.mark.parametrize("seq_len, batch_rows", [(8, 5), (40, 1000)])
def test_blocks_over_triggers_and_restarts(spark, tmp_path, seq_len, batch_rows):
    root, rows, columns = str(tmp_path), rows_of(200), ["input_ids", "widths"]
    cuts = [0, 1, 30, 31, 90, 150, 200]
    parts = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
    # Three files, a trigger each; then a restart for every other file, and one without any.
    for i in range(3):
        arrive(spark, root, parts[i], i)
    schema = drain(spark, root, seq_len, batch_rows, columns, files=1)
    assert streamed(spark, root, schema, seq_len, columns) == whole(spark, sum(parts[:3], []), seq_len, batch_rows, columns)
    for i in range(3, 6):
        arrive(spark, root, parts[i], i)
        drain(spark, root, seq_len, batch_rows, columns)
    drain(spark, root, seq_len, batch_rows, columns)
    assert streamed(spark, root, schema, seq_len, columns) == whole(spark, rows, seq_len, batch_rows, columns)


def test_failure_inside_a_trigger(spark, tmp_path):
    """A micro-batch that fails leaves neither blocks nor state; the next run does it again."""
    root, rows, columns = str(tmp_path), rows_of(90, seed=3), ["input_ids"]
    arrive(spark, root, rows[:40], 0)
    schema = drain(spark, root, 8, 7, columns)
    arrive(spark, root, rows[40:], 1)

    def breaks(df):
        bad = F.when(F.col("k") == 70, F.raise_error(F.lit("this row breaks")).cast("bigint")).otherwise(F.col("k"))
        return df.withColumn("k", bad)

    with pytest.raises(Exception, match="this row breaks"):
        drain(spark, root, 8, 7, columns, change=breaks)
    assert streamed(spark, root, schema, 8, columns) == whole(spark, rows[:40], 8, 7, columns)
    drain(spark, root, 8, 7, columns)
    assert streamed(spark, root, schema, 8, columns) == whole(spark, rows, 8, 7, columns)


@pytest.mark.parametrize("later, match", [([("a", 3, [1], ["1"])], "above all"), ([("a", None, [1], ["1"])], "null"), ([("a", 9, [1], ["1"])] * 2, "above all")])
def test_late_null_and_repeated_keys_are_refused(spark, tmp_path, later, match):
    root = str(tmp_path)
    arrive(spark, root, [("a", 5, [1, 2], ["1", "2"]), ("b", 1, [3], ["3"])], 0)
    drain(spark, root, 8, 7, ["input_ids"])
    arrive(spark, root, later, 1)
    with pytest.raises(Exception, match=match):
        drain(spark, root, 8, 7, ["input_ids"])


def test_string_keys_and_sources_of_several_columns(spark, tmp_path):
    root = str(tmp_path)
    arrive(spark, root, rows_of(60, seed=5), 0)

    def keyed(df):
        return df.select(F.lit("x").alias("shard"), "source", F.lpad(F.col("k").cast("string"), 5, "0").alias("k"), "input_ids")

    stream = keyed(stream_source(spark, f"{root}/in", "parquet", SCHEMA))
    blocks = pack_stream(stream, ["source", "shard"], "k", 8, 7)
    drain_to_parquet(blocks, f"{root}/blocks", f"{root}/progress")
    found = streamed(spark, root, blocks.schema, 8, ["input_ids"])
    assert found == whole(spark, rows_of(60, seed=5), 8, 7, ["input_ids"])


@pytest.mark.parametrize("parts", [0, 1, 3])
def test_streamed_queries_of_a_table_in_a_folder(spark, tmp_path, parts):
    """A table is one file or a folder of files; both come whole, and totals of no rows are none."""
    rows = [(i, "a b" if i % 2 else "c", "en", f"s{i % 3}", 3) for i in range(202)]
    root = f"{tmp_path}/documents.parquet"
    if parts == 1:
        pq.write_table(pa.Table.from_pylist([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]), root)
    elif parts:
        spark.createDataFrame(rows, t.DOCUMENTS).repartition(parts).write.parquet(root)
    else:
        os.mkdir(root)
    totals = R.queries["stream_running_totals"](spark, str(tmp_path)).collect()
    here = rows if parts else []
    expected = {(s, len(n), sum(n)) for s in ("s0", "s1", "s2") if (n := [len(r[1].split()) for r in here if r[3] == s])}
    assert sorted(map(tuple, totals)) == sorted(expected)
    kept = R.queries["stream_source"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, kept)) == [(r[0], len(r[1].split())) for r in here if r[0] * 37 % 101 >= 85]
