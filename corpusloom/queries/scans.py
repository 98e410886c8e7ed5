"""Scans, named sources, file manifests, streams and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.tokenizers import WORDS
from corpusloom.operators.packing import pack_text
from corpusloom.operators.quality import score_filter
from corpusloom.operators.tokens import token_count
from corpusloom.queries import Registry
from corpusloom.queries import tables as t
from corpusloom.session import shared_path
from corpusloom.sources.builds import build_shards
from corpusloom.sources.manifest import (
    config_fingerprint,
    manifest_layout,
    pending_files,
    select_files,
)
from corpusloom.sources.scan import Catalog, Source, scan_files, scan_jsonl, scan_parquet
from corpusloom.sources.store import materialize_or_reuse, write_blocks
from corpusloom.streaming.packing import open_blocks, pack_stream
from corpusloom.streaming.source import (
    drain_to_parquet,
    drain_totals,
    read_totals,
    running_totals,
    stream_source,
)

R = Registry({}, {})


@R.add("scan_parquet", "SELECT doc_id, lang, source, n_chars FROM documents")
def _(spark, sf):
    docs = scan_parquet(spark, f"{sf}/doc*[r-t].par[p-r]uet", t.DOCUMENTS)
    return docs.select("doc_id", "lang", "source", "n_chars")


@R.add("scan_jsonl", "SELECT doc_id, lang, text FROM documents")
def _(spark, sf):
    root = shared_path(spark, "jsonl")
    # One folder per language below root; the scan has to find them by recursion.
    docs = t.documents(spark, sf).select("doc_id", "lang", "text", F.col("lang").alias("folder"))
    docs.write.partitionBy("folder").json(f"{root}/deep")
    return scan_jsonl(spark, root, "doc_id BIGINT, lang STRING, text STRING", glob="*.json")


@R.add("scan_files", "SELECT conv_id, turn, role, text FROM conversations")
def _(spark, sf):
    root = shared_path(spark, "files")
    turns = t.conversations(spark, sf)
    turns.where("role = 'user'").write.json(f"{root}/asked")
    turns.where("role <> 'user' OR role IS NULL").write.json(f"{root}/other")
    return scan_files(spark, [f"{root}/asked", f"{root}/other"], t.CONVERSATIONS)


def _catalog(sf: str) -> Catalog:
    return Catalog().register(
        "corpus",
        Source(
            f"{sf}/{{config}}.parquet",
            schema=t.DOCUMENTS,
            splits={"en": "lang = 'en'", "other": "lang <> 'en' OR lang IS NULL"},
        ),
    )


@R.add("load_source", "SELECT doc_id, source, n_chars FROM documents WHERE lang <> 'en' OR lang IS NULL")
def _(spark, sf):
    return _catalog(sf).load_source(spark, "corpus", "documents", "other").select(
        "doc_id", "source", "n_chars"
    )


@R.add(
    "select_files",
    f"""WITH {t.MANIFEST_SQL} SELECT page_id, rfilename FROM manifest
WHERE regexp_matches(rfilename, '.*\\.example\\.com/.*|/en/') AND NOT regexp_matches(rfilename, '#top')""",
)
def _(spark, sf):
    files = t.manifest(spark, sf).select("page_id", "rfilename")
    return select_files(files, ["*.example.com/*", "/en/"], ["#top"])


@R.add(
    "manifest_layout",
    f"""WITH {t.MANIFEST_SQL} SELECT rfilename,
  'https://files.example.org/datasets/corpus/resolve/main/' || rfilename AS url,
  CASE WHEN contains(rfilename, '/') THEN regexp_extract(rfilename, '(?s)^(.*)/[^/]*$', 1) ELSE '' END AS dir,
  list_extract(string_split(rfilename, '/'), -1) AS out FROM manifest""",
)
def _(spark, sf):
    files = t.manifest(spark, sf).select("rfilename")
    return manifest_layout(files, "https://files.example.org", "datasets/corpus")


@R.add(
    "pending_files",
    f"""WITH {t.MANIFEST_SQL}, done AS (SELECT rfilename FROM manifest WHERE length(html) >= 2000)
SELECT page_id, rfilename FROM manifest WHERE rfilename NOT IN (SELECT rfilename FROM done)""",
)
def _(spark, sf):
    pages = t.manifest(spark, sf)
    done = pages.where(F.length("html") >= 2000).select("rfilename")
    return pending_files(pages.select("page_id", "rfilename"), done)


@R.add(
    "pending_files_same_options",
    f"""WITH {t.MANIFEST_SQL}, done AS (
  SELECT rfilename FROM manifest WHERE length(html) >= 2000 AND contains(rfilename, '.example.com/'))
SELECT page_id, rfilename FROM manifest WHERE rfilename NOT IN (SELECT rfilename FROM done)""",
)
def _(spark, sf):
    pages = t.manifest(spark, sf)
    now = {"include": ["*.parquet"], "revision": "main"}
    before = {"include": ["*.jsonl"], "revision": "main"}
    done = pages.where(F.length("html") >= 2000).select(
        "rfilename",
        F.when(F.col("rfilename").contains(".example.com/"), config_fingerprint(now))
        .otherwise(config_fingerprint(before))
        .alias("fingerprint"),
    )
    return pending_files(pages.select("page_id", "rfilename"), done, now)


@R.add(
    "stream_source",
    f"""WITH {t.KEPT_SQL} SELECT doc_id, CAST(len({t.words_sql("content")}) AS INTEGER) AS num_tokens FROM kept""",
)
def _(spark, sf):
    stream = stream_source(spark, f"{sf}/documents.parquet", "parquet", t.DOCUMENTS)
    scored = stream.select(
        "doc_id",
        F.col("text").alias("content"),
        ((F.col("doc_id") * 37 % 101) / F.lit(100.0)).cast("string").alias("score"),
    )
    counted = token_count(score_filter(scored), "content", ["doc_id"])
    out = shared_path(spark, "stream")
    drain_to_parquet(counted, f"{out}/rows", f"{out}/progress")
    return spark.read.schema(counted.schema).parquet(f"{out}/rows")


@R.add(
    "stream_running_totals",
    f"""SELECT source, count(*) AS num_rows, CAST(sum(len({t.words_sql("text")})) AS BIGINT) AS total_tokens
FROM documents GROUP BY source""",
)
def _(spark, sf):
    stream = stream_source(spark, f"{sf}/documents.parquet", "parquet", t.DOCUMENTS)
    totals = running_totals(stream, "text", ["source"])
    out = shared_path(spark, "totals")
    drain_totals(totals, f"{out}/rows", f"{out}/progress")
    return read_totals(spark, f"{out}/rows", totals.schema)


_STREAM_SEQ, _STREAM_ROWS, _STREAM_PARTS = 128, 50, 4


@R.add(
    "pack_stream",
    f"""WITH r AS (SELECT source, dense_rank() OVER (ORDER BY source NULLS FIRST) AS s,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rn, {t.words_sql("text")} AS ids FROM documents),
  names AS (SELECT DISTINCT s, source FROM r), numbered AS (
  SELECT s * 1000000000 + rn // {_STREAM_ROWS} AS b, rn, ids FROM r), {t.pack_sql("numbered", _STREAM_SEQ, "b")}
SELECT source, batch_id % 1000000000 AS batch_id, block_id, input_ids
FROM packed JOIN names ON s = batch_id // 1000000000""",
)
def _(spark, sf):
    """Every source packed as its files arrive; the query stops and goes on from its checkpoint between arrivals."""
    docs = t.documents(spark, sf)
    out = shared_path(spark, "packed-stream")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    step = ((high or 0) - (low or 0)) // _STREAM_PARTS + 1
    for part in range(_STREAM_PARTS):
        arrived = docs.where(F.call_function("div", F.col("doc_id") - (low or 0), F.lit(step)) == part)
        arrived.write.parquet(f"{out}/in/{part}")
        stream = stream_source(spark, f"{out}/in", "parquet", t.DOCUMENTS)
        ids = stream.select("source", "doc_id", WORDS.tokens("text").alias("input_ids"))
        blocks = pack_stream(ids, ["source"], "doc_id", _STREAM_SEQ, _STREAM_ROWS)
        drain_to_parquet(blocks, f"{out}/blocks", f"{out}/progress")
    full = spark.read.schema(blocks.schema).parquet(f"{out}/blocks")
    every = full.unionByName(open_blocks(spark, f"{out}/progress", _STREAM_SEQ))
    return every.select("source", "batch_id", "block_id", t.joined("input_ids").alias("input_ids"))


@R.add(
    "materialize_or_reuse",
    f"""SELECT doc_id, CAST(len({t.words_sql("text")}) AS INTEGER) AS num_tokens FROM documents""",
)
def _(spark, sf):
    path = f"{shared_path(spark, 'processed')}/counts"

    def build():
        return token_count(t.documents(spark, sf), "text", ["doc_id"])

    def must_not_build():
        raise AssertionError("the finished table was not reused")

    materialize_or_reuse(spark, path, build)
    return materialize_or_reuse(spark, path, must_not_build)


@R.add(
    "write_blocks",
    f"""WITH r AS (SELECT row_number() OVER (ORDER BY item_id) - 1 AS rn, {t.words_sql("text")} AS ids
  FROM benchmark), {t.pack_sql("r", 64, "rn // 16")}
SELECT 'benchmark' AS source, batch_id, block_id, input_ids FROM packed""",
)
def _(spark, sf):
    items = t.table(spark, sf, "benchmark", t.BENCHMARK)
    blocks = pack_text(items, "text", "item_id", 64, 16, tokenizer=WORDS)
    path = f"{shared_path(spark, 'blocks')}/out"
    write_blocks(blocks.withColumn("source", F.lit("benchmark")), path)
    return spark.read.parquet(path).select(
        "source", "batch_id", "block_id", t.joined("input_ids").alias("input_ids")
    )


@R.add(
    "build_shards",
    f"""SELECT doc_id, lang, CAST(len({t.words_sql("text")}) AS INTEGER) AS num_tokens FROM documents""",
)
def _(spark, sf):
    """A build that breaks, resumes by shard, and is then built anew because an option changed."""
    root = f"{shared_path(spark, 'builds')}/corpus"
    docs = t.documents(spark, sf)
    built = []

    def shard(condition, column, fails=False):
        def build():
            if fails:
                raise RuntimeError("this shard breaks")
            built.append(condition)
            return token_count(docs.where(condition), column, ["doc_id", "lang"])

        return build

    parts = {"en": "lang = 'en'", "others": "lang <> 'en'", "unknown": "lang IS NULL"}
    before, now = {"column": "lang", "tokenizer": "words"}, {"column": "text", "tokenizer": "words"}
    try:
        build_shards(spark, root, {k: shard(c, "lang", k == "unknown") for k, c in parts.items()}, before)
    except RuntimeError:
        build_shards(spark, root, {k: shard(c, "lang") for k, c in parts.items()}, before)
    if built != list(parts.values()):
        raise AssertionError("finished shards were built again")
    return build_shards(spark, root, {k: shard(c, "text") for k, c in parts.items()}, now)
