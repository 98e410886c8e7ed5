"""Tokenization, vocabulary and counting."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.tokenizers import BYTES
from corpusloom.operators import tokens as k
from corpusloom.operators.quality import score_filter
from corpusloom.queries import Registry
from corpusloom.queries import tables as t

R = Registry({}, {})
KEY = ["conv_id", "turn"]

_DOC_WORDS = f"words AS (SELECT doc_id, {t.words_sql('text')} AS ids FROM documents)"
_VOCAB = f"""{_DOC_WORDS}, vocab AS (
  SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token) - 1 AS token_id
  FROM (SELECT token, count(*) AS freq FROM (SELECT unnest(ids) AS token FROM words) GROUP BY token))"""


def _doc_words(spark, sf):
    return k.tokenize(t.documents(spark, sf), "text", ["doc_id"])


@R.add(
    "tokenize",
    f"""WITH {_DOC_WORDS} SELECT doc_id, array_to_string(ids, ' ') AS input_ids,
  rtrim(repeat('1 ', len(ids))) AS attention_mask FROM words""",
)
def _(spark, sf):
    return _doc_words(spark, sf).select(
        "doc_id",
        t.joined("input_ids").alias("input_ids"),
        t.joined("attention_mask").alias("attention_mask"),
    )


@R.add(
    "tokenize_bytes",
    f"""SELECT conv_id, turn, array_to_string({t.bytes_sql("text")}, ' ') AS input_ids FROM conversations""",
)
def _(spark, sf):
    ids = k.tokenize(t.conversations(spark, sf), "text", KEY, BYTES)
    return ids.select(*KEY, t.joined("input_ids").alias("input_ids"))


@R.add(
    "tokenize_pair",
    f"""WITH {t.INSTRUCT_SQL} SELECT conv_id, turn, array_to_string(
  list_concat({t.words_sql("prompt")}, {t.words_sql("response")}), ' ') AS input_ids FROM instruct""",
)
def _(spark, sf):
    pair = k.tokenize_pair(t.instruct(spark, sf), "prompt", "response", KEY)
    return pair.select(*KEY, t.joined("input_ids").alias("input_ids"))


@R.add("vocab", f"WITH {_VOCAB} SELECT token, freq, token_id FROM vocab")
def _(spark, sf):
    return k.vocab(_doc_words(spark, sf))


@R.add("vocab_top", f"WITH {_VOCAB} SELECT token, freq, token_id FROM vocab WHERE token_id < 5000")
def _(spark, sf):
    return k.vocab(_doc_words(spark, sf), max_size=5000)


_ENCODED = f"""WITH {_VOCAB}, flat AS (
  SELECT doc_id, unnest(ids) AS token, unnest(range(len(ids))) AS i FROM words)
SELECT doc_id, string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY i) AS input_ids
FROM flat JOIN vocab USING (token) GROUP BY doc_id"""


@R.add("encode_ids_large", _ENCODED)
def _(spark, sf):
    """The same by joining the vocabulary, as any real corpus needs."""
    words = _doc_words(spark, sf)
    ids = k.encode_ids(words, k.vocab(words), "doc_id", in_place_rows=0)
    return ids.select("doc_id", t.joined("input_ids").alias("input_ids"))


@R.add("encode_ids", _ENCODED)
def _(spark, sf):
    words = _doc_words(spark, sf)
    ids = k.encode_ids(words, k.vocab(words), "doc_id")
    return ids.select("doc_id", t.joined("input_ids").alias("input_ids"))


@R.add(
    "decode_ids",
    f"""WITH {_VOCAB}, flat AS (
  SELECT doc_id, unnest(ids) AS token, unnest(range(len(ids))) AS i FROM words)
SELECT doc_id, coalesce(string_agg(token, ' ' ORDER BY i) FILTER (token_id >= 2), '') AS text
FROM flat JOIN vocab USING (token) GROUP BY doc_id""",
)
def _(spark, sf):
    words = _doc_words(spark, sf)
    vocabulary = k.vocab(words)
    # The two most frequent tokens stand for special ones.
    return k.decode_ids(
        k.encode_ids(words, vocabulary, "doc_id"), vocabulary, "doc_id", special_ids=[0, 1]
    )


@R.add(
    "truncate",
    f"WITH {_DOC_WORDS} SELECT doc_id, array_to_string(ids[1:64], ' ') AS input_ids FROM words",
)
def _(spark, sf):
    cut = k.truncate(_doc_words(spark, sf), 64)
    return cut.select("doc_id", t.joined("input_ids").alias("input_ids"))


@R.add(
    "query_rows",
    f"""WITH {t.INSTRUCT_SQL}, q AS (SELECT conv_id, turn, prompt, {t.words_sql("prompt")}[1:16] AS ids FROM instruct)
SELECT conv_id, turn, prompt, array_to_string(ids, '|') AS input_ids, array_to_string(ids, ' ') AS query FROM q""",
)
def _(spark, sf):
    rows = k.query_rows(t.instruct(spark, sf), "prompt", 16, KEY)
    return rows.select(*KEY, "prompt", t.joined("input_ids", "|").alias("input_ids"), "query")


@R.add(
    "token_count",
    f"SELECT doc_id, CAST(len({t.words_sql('text')}) AS INTEGER) AS num_tokens FROM documents",
)
def _(spark, sf):
    return k.token_count(t.documents(spark, sf), "text", ["doc_id"])


@R.add(
    "token_count_pair",
    f"""WITH {t.INSTRUCT_SQL} SELECT conv_id, turn,
  CAST(len({t.words_sql("prompt")}) + len({t.words_sql("response")}) AS INTEGER) AS num_tokens FROM instruct""",
)
def _(spark, sf):
    return k.token_count(t.instruct(spark, sf), "prompt", KEY, second="response")


@R.add(
    "total_tokens",
    f"SELECT CAST(sum(len({t.words_sql('text')})) AS BIGINT) AS total_tokens FROM documents",
)
def _(spark, sf):
    return k.total_tokens(t.documents(spark, sf), "text")


@R.add(
    "total_tokens_filtered",
    f"WITH {t.KEPT_SQL} SELECT CAST(sum(octet_length(encode(content))) AS BIGINT) AS total_tokens FROM kept",
)
def _(spark, sf):
    return k.total_tokens(score_filter(t.web_corpus(spark, sf)), "content", tokenizer=BYTES)


@R.add(
    "token_report",
    f"""WITH c AS (SELECT CAST(sum(len({t.words_sql("text")})) AS BIGINT) AS total_tokens FROM documents)
SELECT total_tokens, format('{{:.3f}}B', total_tokens / 1e9) AS billions,
  format('{{:.6f}}b', total_tokens / 1073741824.0) AS binary_billions FROM c""",
)
def _(spark, sf):
    return k.token_report(k.total_tokens(t.documents(spark, sf), "text"))


@R.add(
    "estimate_total",
    f"""WITH s AS (SELECT {t.words_sql("text")} AS ids FROM documents ORDER BY doc_id LIMIT 500)
SELECT count(*) AS sampled_rows, (SELECT count(*) FROM documents) AS total_rows, round(avg(len(ids)), 6) AS avg_tokens,
  round(avg(len(ids)) * (SELECT count(*) FROM documents), 3) AS estimated_tokens FROM s""",
)
def _(spark, sf):
    estimate = k.estimate_total(t.documents(spark, sf), "text", "doc_id", 500)
    return estimate.select(
        "sampled_rows",
        "total_rows",
        F.round("avg_tokens", 6).alias("avg_tokens"),
        F.round("estimated_tokens", 3).alias("estimated_tokens"),
    )


@R.add(
    "source_report",
    f"""SELECT source, lang, count(*) AS num_rows, CAST(sum(len({t.words_sql("text")})) AS BIGINT) AS total_tokens
FROM documents GROUP BY source, lang""",
)
def _(spark, sf):
    return k.source_report(t.documents(spark, sf), "text", ["source", "lang"])


@R.add(
    "source_rollup",
    f"""SELECT coalesce(source, '(all)') AS source, coalesce(lang, '(all)') AS lang, count(*) AS num_rows,
  CAST(sum(len({t.words_sql("text")})) AS BIGINT) AS total_tokens FROM documents GROUP BY ROLLUP (source, lang)""",
)
def _(spark, sf):
    return k.source_rollup(t.documents(spark, sf), "text", ["source", "lang"])


@R.add(
    "estimate_sources",
    f"""WITH n AS (SELECT doc_id, source, CAST(len({t.words_sql("text")}) AS DOUBLE) AS n,
    row_number() OVER (PARTITION BY source ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS place,
    count(*) OVER (PARTITION BY source) AS num_rows FROM documents), e AS (
  SELECT source, max(num_rows) AS num_rows, count(*) AS sampled_rows, avg(n) AS avg_tokens, coalesce(var_samp(n), 0) AS v
  FROM n WHERE place <= 40 GROUP BY source), s AS (
  SELECT *, avg_tokens * num_rows AS total, num_rows * sqrt(v / sampled_rows * (1 - sampled_rows / num_rows)) AS err FROM e)
SELECT source, num_rows, sampled_rows, round(avg_tokens, 6) AS avg_tokens, round(total, 3) AS estimated_tokens,
  round(err, 3) AS std_error, round(total - 1.96 * err, 3) AS low, round(total + 1.96 * err, 3) AS high FROM s""",
)
def _(spark, sf):
    found = k.estimate_sources(t.documents(spark, sf), "text", ["source"], "doc_id", 40)
    digits = {"avg_tokens": 6, "estimated_tokens": 3, "std_error": 3, "low": 3, "high": 3}
    return found.withColumns({c: F.round(c, d) for c, d in digits.items()})
