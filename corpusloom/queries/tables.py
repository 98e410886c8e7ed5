"""The given tables and the corpora derived from them, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.dialogue import exchanges
from corpusloom.sources.scan import scan_parquet

DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
CONVERSATIONS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
LABELS = "doc_id BIGINT, quality INT, toxic INT"
PAGES = "page_id BIGINT, url STRING, html STRING"
BENCHMARK = "item_id BIGINT, text STRING"
EMBEDDINGS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def table(spark: SparkSession, sf: str, name: str, schema: str) -> DataFrame:
    return scan_parquet(spark, f"{sf}/{name}.parquet", schema)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents", DOCUMENTS)


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations", CONVERSATIONS)


def web_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a made-up quality score, kept as text as web corpora have it."""
    score = (F.col("doc_id") * 37 % 101) / F.lit(100.0)
    return documents(spark, sf).select(
        "doc_id", F.col("text").alias("content"), score.cast("string").alias("score"), "lang", "source"
    )


def instruct(spark: SparkSession, sf: str) -> DataFrame:
    return exchanges(conversations(spark, sf))


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages", PAGES).select(
        "page_id", F.regexp_replace("url", "^https?://", "").alias("rfilename"), "html"
    )


def joined(c: Column | str, separator: str = " ") -> Column:
    """An array as one string, so that both engines hash it alike."""
    column = F.col(c) if isinstance(c, str) else c
    return F.array_join(column.cast("array<string>"), separator)


WEB_SQL = """web AS (
  SELECT doc_id, text AS content, CAST(((doc_id * 37) % 101) / 100.0 AS VARCHAR) AS score, lang, source
  FROM documents)"""

KEPT_SQL = f"""{WEB_SQL}, kept AS (
  SELECT * FROM web WHERE TRY_CAST(score AS DOUBLE) >= 0.85 AND NOT isnan(TRY_CAST(score AS DOUBLE)))"""

INSTRUCT_SQL = """instruct AS (
  SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

MANIFEST_SQL = """manifest AS (
  SELECT page_id, regexp_replace(url, '^https?://', '') AS rfilename, html FROM pages)"""

# The whitespace set of str_strip, built from code points.
SPACES_SQL = "||".join(
    f"chr({c})"
    for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def words_sql(text: str) -> str:
    return f"regexp_extract_all({text}, '[^ \\t\\n\\r]+')"


def bytes_sql(text: str) -> str:
    return (
        f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS INTEGER))"
    )


def strip_sql(text: str) -> str:
    return f"trim({text}, {SPACES_SQL})"


def turn_sql(role: str, text: str, think: str = "''") -> str:
    return f"'<|im_start|>' || {role} || chr(10) || {think} || {text} || '<|im_end|>' || chr(10)"


THINK_SQL = "'<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10)"

RENDERED_SQL = f"""rendered AS (
  SELECT conv_id, string_agg({turn_sql(
      "role", "text", f"CASE WHEN role = 'assistant' AND turn = last_turn THEN {THINK_SQL} ELSE '' END"
  )}, '' ORDER BY turn) AS text
  FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last_turn FROM conversations) GROUP BY conv_id)"""


def exchange_sql(user: str, assistant: str) -> str:
    return turn_sql("'user'", user) + " || " + turn_sql("'assistant'", assistant, THINK_SQL)


def pack_sql(rows: str, seq_len: int, batch: str) -> str:
    """CTEs ending in ``packed(batch_id, block_id, input_ids)``. ``rows`` names a table with
    ``rn`` (0-based row number) and ``ids``; ``batch`` is the batch number's expression."""
    return f"""flat AS (
  SELECT {batch} AS b, rn, unnest(ids) AS t, unnest(range(len(ids))) AS i FROM {rows}), placed AS (
  SELECT b, t, row_number() OVER (PARTITION BY b ORDER BY rn, i) - 1 AS p,
         count(*) OVER (PARTITION BY b) AS total FROM flat), packed AS (
  SELECT CAST(b AS BIGINT) AS batch_id, CAST(p // {seq_len} AS BIGINT) AS block_id,
         string_agg(CAST(t AS VARCHAR), ' ' ORDER BY p) AS input_ids, count(*) AS n
  FROM placed WHERE total < {seq_len} OR p < (total // {seq_len}) * {seq_len} GROUP BY 1, 2)"""
