"""Packing and the source mixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators.ordering import order_key
from corpusloom.operators.packing import concat_sources, pack, pack_report, pack_text
from corpusloom.operators.quality import score_filter
from corpusloom.operators.tokens import token_count, tokenize
from corpusloom.plans.pretrain import CorpusSource, pretrain_mixture
from corpusloom.queries import Registry
from corpusloom.queries import tables as t

R = Registry({}, {})

SEQ, ROWS = 128, 100

_NUMBERED = f"""r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rn,
  {t.words_sql("content")} AS ids FROM kept)"""


def _kept(spark, sf):
    return score_filter(t.web_corpus(spark, sf))


def _blocks(df):
    return df.select("batch_id", "block_id", t.joined("input_ids").alias("input_ids"))


@R.add(
    "pack",
    f"""WITH {t.KEPT_SQL}, {_NUMBERED}, {t.pack_sql("r", SEQ, f"rn // {ROWS}")}
SELECT batch_id, block_id, input_ids FROM packed""",
)
def _(spark, sf):
    ids = tokenize(_kept(spark, sf), "content", ["doc_id"])
    return _blocks(pack(ids, "doc_id", SEQ, ROWS))


# Seven contiguous shards: the first n % 7 hold one row more. Batches restart in each.
_SHARDED = f"""{_NUMBERED}, size AS (SELECT count(*) // 7 AS q, count(*) % 7 AS m FROM r), sharded AS (
  SELECT rn, ids, s, rn - (s * q + least(s, m)) AS local FROM (
    SELECT rn, ids, q, m, CASE WHEN rn < m * (q + 1) THEN rn // (q + 1) ELSE m + (rn - m * (q + 1)) // q END AS s
    FROM r, size)), numbered AS (
  SELECT rn, ids, dense_rank() OVER (ORDER BY s, local // 20) - 1 AS batch FROM sharded)"""


@R.add(
    "pack_shards",
    f"""WITH {t.KEPT_SQL}, {_SHARDED}, {t.pack_sql("numbered", SEQ, "batch")}
SELECT batch_id, block_id, input_ids FROM packed""",
)
def _(spark, sf):
    return _blocks(pack_text(_kept(spark, sf), "content", "doc_id", SEQ, 20, shards=7))


@R.add(
    "pack_columns",
    f"""WITH r AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS rn, {t.words_sql("text")} AS ids FROM documents),
  {t.pack_sql("r", 256, "rn // 64")}
SELECT batch_id, block_id, input_ids, rtrim(repeat('1 ', n)) AS attention_mask,
  array_to_string(list_transform(string_split(input_ids, ' '), lambda x: length(x)), ' ') AS widths FROM packed""",
)
def _(spark, sf):
    ids = tokenize(t.documents(spark, sf), "text", ["doc_id"])
    rows = ids.withColumn("widths", F.transform("input_ids", F.length))
    columns = ["input_ids", "attention_mask", "widths"]
    blocks = pack(rows, "doc_id", 256, 64, columns)
    return blocks.select("batch_id", "block_id", *[t.joined(c).alias(c) for c in columns])


def _report_sql(rows: str, order: str, text: str) -> str:
    return f"""SELECT CAST(coalesce(sum(CASE WHEN t >= {SEQ} THEN t // {SEQ} WHEN t > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS blocks,
  CAST(coalesce(sum(CASE WHEN t >= {SEQ} THEN t - t % {SEQ} ELSE t END), 0) AS BIGINT) AS kept_tokens,
  CAST(coalesce(sum(CASE WHEN t >= {SEQ} THEN t % {SEQ} ELSE 0 END), 0) AS BIGINT) AS dropped_tokens
FROM (SELECT sum(n) AS t FROM (SELECT (row_number() OVER (ORDER BY {order}) - 1) // {ROWS} AS b,
  len({t.words_sql(text)}) AS n FROM {rows}) GROUP BY b)"""


@R.add(
    "pack_report",
    f"""WITH {t.KEPT_SQL}
SELECT 'web' AS source, 0 AS source_ord, * FROM ({_report_sql("kept", "doc_id", "content")})
UNION ALL SELECT 'benchmark', 1, * FROM ({_report_sql("benchmark", "item_id", "text")})""",
)
def _(spark, sf):
    web = token_count(_kept(spark, sf), "content", ["doc_id"])
    items = token_count(t.table(spark, sf, "benchmark", t.BENCHMARK), "text", ["item_id"])
    return concat_sources(
        {
            "web": pack_report(web, "doc_id", SEQ, ROWS),
            "benchmark": pack_report(items, "item_id", SEQ, ROWS),
        }
    )


@R.add(
    "concat_sources",
    """SELECT 'documents' AS source, 0 AS source_ord, doc_id, lang, NULL AS item_id, text FROM documents
UNION ALL SELECT 'benchmark', 1, NULL, NULL, item_id, text FROM benchmark""",
)
def _(spark, sf):
    return concat_sources(
        {
            "documents": t.documents(spark, sf).select("doc_id", "lang", "text"),
            "benchmark": t.table(spark, sf, "benchmark", t.BENCHMARK),
        }
    )


def _mixture_sql(seq: int, rows: int) -> str:
    prompt = "'### Instruction:' || chr(10) || prompt || chr(10) || '### Response:' || chr(10) || response"
    parts = {
        "web_other": f"SELECT row_number() OVER (ORDER BY doc_id) - 1 AS rn, {t.words_sql('content')} AS ids FROM kept WHERE lang <> 'en' OR lang IS NULL",
        "instruct": f"SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS rn, {t.words_sql(prompt)} AS ids FROM instruct",
        "web_en": f"SELECT row_number() OVER (ORDER BY doc_id) - 1 AS rn, {t.words_sql('content')} AS ids FROM kept WHERE lang = 'en'",
        "reference_texts": f"SELECT row_number() OVER (ORDER BY item_id) - 1 AS rn, {t.words_sql('text')} AS ids FROM benchmark",
    }
    unions = []
    for i, (name, select) in enumerate(parts.items()):
        unions.append(
            f"""SELECT '{name}' AS source, {i} AS source_ord, batch_id, block_id, input_ids,
  rtrim(repeat('1 ', n)) AS attention_mask FROM (WITH r AS ({select}), {t.pack_sql("r", seq, f"rn // {rows}")}
  SELECT * FROM packed)"""
        )
    return f"WITH {t.KEPT_SQL}, {t.INSTRUCT_SQL} " + " UNION ALL ".join(unions)


def mixture(spark, sf, seq_len=1024, batch_rows=1024):
    """The four-source mixture over the given tables."""
    web = t.web_corpus(spark, sf)
    dialogue = t.instruct(spark, sf).withColumn("row_key", order_key("conv_id", "turn"))
    items = t.table(spark, sf, "benchmark", t.BENCHMARK)
    return pretrain_mixture(
        {
            "web_other": CorpusSource(web.where("lang <> 'en' OR lang IS NULL"), "doc_id", score="score"),
            "instruct": CorpusSource(dialogue, "row_key", instruct=True),
            "web_en": CorpusSource(web.where("lang = 'en'"), "doc_id", score="score"),
            "reference_texts": CorpusSource(items, "item_id", text="text"),
        },
        seq_len,
        batch_rows,
    )


@R.add("pretrain_mixture", _mixture_sql(1024, 1024))
def pretrain_mixture_query(spark, sf):
    return mixture(spark, sf).select(
        "source",
        "source_ord",
        "batch_id",
        "block_id",
        t.joined("input_ids").alias("input_ids"),
        t.joined("attention_mask").alias("attention_mask"),
    )


@R.add("pretrain_mixture_short_blocks", _mixture_sql(128, 50))
def _(spark, sf):
    return mixture(spark, sf, 128, 50).select(
        "source",
        "source_ord",
        "batch_id",
        "block_id",
        t.joined("input_ids").alias("input_ids"),
        t.joined("attention_mask").alias("attention_mask"),
    )


@R.add(
    "pack_tied",
    f"""WITH rows AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS rn, {t.words_sql("text")} AS ids
  FROM conversations), {t.pack_sql("rows", 128, "rn // 50")} SELECT batch_id, block_id, input_ids FROM packed""",
)
def _(spark, sf):
    """Turns packed in the order of two columns, the first of which repeats."""
    turns = t.conversations(spark, sf).withColumn("place", order_key("conv_id", "turn"))
    blocks = pack_text(turns, "text", "place", seq_len=128, batch_rows=50)
    return blocks.select("batch_id", "block_id", t.joined("input_ids").alias("input_ids"))
