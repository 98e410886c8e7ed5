"""Quality filter, projection, positional rows and string helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.text import split_once, str_strip
from corpusloom.operators.ordering import order_key
from corpusloom.operators.quality import (
    drop_source_columns,
    row_at,
    score_filter,
    score_rejects,
    slice_rows,
    take,
    take_batches,
)
from corpusloom.queries import Registry
from corpusloom.queries import tables as t

R = Registry({}, {})


@R.add("score_filter", f"WITH {t.KEPT_SQL} SELECT doc_id, score, lang FROM kept")
def _(spark, sf):
    return score_filter(t.web_corpus(spark, sf)).select("doc_id", "score", "lang")


@R.add("score_filter_numeric", "SELECT doc_id, quality FROM labels WHERE quality >= 1")
def _(spark, sf):
    labels = t.table(spark, sf, "labels", t.LABELS)
    return score_filter(labels, "quality", 1).select("doc_id", "quality")


@R.add(
    "score_rejects",
    """SELECT doc_id, score FROM (
  SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), d.source) AS score FROM documents d LEFT JOIN labels l USING (doc_id))
WHERE TRY_CAST(score AS DOUBLE) IS NULL""",
)
def _(spark, sf):
    # Unlabelled documents carry their source's name where the score should be.
    labels = t.table(spark, sf, "labels", t.LABELS)
    scored = t.documents(spark, sf).join(labels, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("quality").cast("string"), "source").alias("score")
    )
    return score_rejects(scored)


@R.add("drop_source_columns", "SELECT doc_id, length(text) AS chars FROM documents")
def _(spark, sf):
    docs = t.documents(spark, sf).withColumn("chars", F.length("text").cast("bigint"))
    return drop_source_columns(docs, ["text", "lang", "source", "n_chars"])


@R.add("take", "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 100")
def _(spark, sf):
    return take(t.documents(spark, sf).select("doc_id", "lang", "text"), 100, "doc_id")


@R.add("slice_rows", "SELECT doc_id, lang, text FROM documents ORDER BY doc_id OFFSET 10 LIMIT 40")
def _(spark, sf):
    return slice_rows(t.documents(spark, sf).select("doc_id", "lang", "text"), 10, 50, "doc_id")


@R.add("take_batches", "SELECT conv_id, turn, text FROM conversations ORDER BY conv_id, turn LIMIT 408")
def _(spark, sf):
    turns = t.conversations(spark, sf).withColumn("key", order_key("conv_id", "turn"))
    return take_batches(turns, 100, 4, "key").select("conv_id", "turn", "text")


@R.add("row_at", "SELECT doc_id, lang, text FROM documents ORDER BY doc_id OFFSET 3 LIMIT 1")
def _(spark, sf):
    return row_at(t.documents(spark, sf).select("doc_id", "lang", "text"), 3, "doc_id")


@R.add(
    "str_strip",
    f"""SELECT doc_id, {t.strip_sql("chr(12288) || chr(9) || chr(28) || text || chr(133) || chr(10) || ' '")} AS text
FROM documents""",
)
def _(spark, sf):
    padded = F.concat(F.lit("　\t\x1c"), "text", F.lit("\x85\n "))
    return t.documents(spark, sf).select("doc_id", str_strip(padded).alias("text"))


@R.add(
    "split_once",
    """SELECT page_id, CASE WHEN i > 0 THEN substr(html, 1, i - 1) ELSE html END AS head,
  CASE WHEN i > 0 THEN substr(html, i + length('<body>')) END AS rest
FROM (SELECT page_id, html, strpos(html, '<body>') AS i FROM pages)""",
)
def _(spark, sf):
    pages = t.table(spark, sf, "pages", t.PAGES).withColumn("_p", split_once("html", "<body>"))
    return pages.select(
        "page_id", F.get("_p", F.lit(0)).alias("head"), F.get("_p", F.lit(1)).alias("rest")
    )


def _tied(spark, sf):
    """Turns by conversation, whose number repeats, and turn."""
    turns = t.conversations(spark, sf).select("conv_id", "turn", "text")
    return turns.withColumn("place", order_key("conv_id", "turn"))


@R.add("take_tied", "SELECT conv_id, turn, text FROM conversations ORDER BY conv_id, turn LIMIT 101")
def _(spark, sf):
    return take(_tied(spark, sf), 101, "place").drop("place")


@R.add("row_at_tied", "SELECT conv_id, turn, text FROM conversations ORDER BY conv_id, turn OFFSET 42 LIMIT 1")
def _(spark, sf):
    return row_at(_tied(spark, sf), 42, "place").drop("place")
