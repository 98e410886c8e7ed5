"""Labels, masks, positions and offsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.chatml import TURN_START
from corpusloom.functions.tokenizers import BYTES, WORDS
from corpusloom.operators import labels as m
from corpusloom.operators.dialogue import render_conversation
from corpusloom.operators.tokens import tokenize
from corpusloom.plans.finetune import sft_dataset, sft_examples
from corpusloom.queries import Registry
from corpusloom.queries import tables as t

R = Registry({}, {})

USER, ASSISTANT = f"{TURN_START}user", f"{TURN_START}assistant"
_WORDS = f"words AS (SELECT doc_id, {t.words_sql('text')} AS ids FROM documents)"


def _doc_words(spark, sf):
    return tokenize(t.documents(spark, sf), "text", ["doc_id"])


def _padded(spark, sf):
    # Longer rows stay whole.
    return m.pad_batch(_doc_words(spark, sf), 256, "<pad>")


_PADDED = f"""{_WORDS}, padded AS (
  SELECT doc_id, list_concat(ids, list_transform(range(256 - len(ids)), lambda x: '<pad>')) AS ids,
    list_concat(list_transform(ids, lambda x: 1), list_transform(range(256 - len(ids)), lambda x: 0)) AS mask FROM words)"""


@R.add(
    "pad_batch",
    f"""WITH {_PADDED} SELECT doc_id, array_to_string(ids, ' ') AS input_ids,
  array_to_string(mask, ' ') AS attention_mask FROM padded""",
)
def _(spark, sf):
    return _padded(spark, sf).select(
        "doc_id", *[t.joined(c).alias(c) for c in ("input_ids", "attention_mask")]
    )


@R.add(
    "pad_longest",
    f"""WITH {_WORDS}, numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM words), wide AS (
  SELECT *, rn // 50 AS batch_id, max(len(ids)) OVER (PARTITION BY rn // 50) - len(ids) AS short FROM numbered)
SELECT doc_id, CAST(batch_id AS BIGINT) AS batch_id,
  array_to_string(list_concat(ids, list_transform(range(short), lambda x: '<pad>')), ' ') AS input_ids,
  array_to_string(list_concat(list_transform(ids, lambda x: 1), list_transform(range(short), lambda x: 0)), ' ')
    AS attention_mask FROM wide""",
)
def _(spark, sf):
    padded = m.pad_longest(_doc_words(spark, sf), "<pad>", "doc_id", 50)
    return padded.select(
        "doc_id", "batch_id", *[t.joined(c).alias(c) for c in ("input_ids", "attention_mask")]
    )


@R.add(
    "causal_labels",
    f"""WITH {_PADDED} SELECT doc_id, array_to_string(
  list_transform(ids, lambda x: CASE WHEN x = '<pad>' THEN '-100' ELSE x END), ' ') AS labels FROM padded""",
)
def _(spark, sf):
    labelled = m.causal_labels(_padded(spark, sf), "<pad>")
    return labelled.select("doc_id", t.joined("labels").alias("labels"))


def _completion_sql(ids: str, user: list, assistant: list) -> str:
    """CTEs ending in ``labelled(conv_id, i, x, label)``, one row per token."""

    def quoted(values):
        return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"

    def starts(marker, shift):
        return (
            f"list_transform(list_filter(range(len(ids)), lambda i: ids[i + 1:i + {len(marker)}] = {quoted(marker)}),"
            f" lambda i: i + {shift})"
        )

    ignored = "'-100'" if isinstance(user[0], str) else "-100"
    return f"""{t.RENDERED_SQL}, base AS (SELECT conv_id, {ids} AS ids FROM rendered), found AS (
  SELECT conv_id, ids, {starts(user, 0)} AS h0, {starts(assistant, len(assistant))} AS r FROM base), marks AS (
  SELECT conv_id, ids, r, CASE WHEN h0[1] > r[1] THEN list_prepend(0, h0) ELSE h0 END AS h FROM found), labelled AS (
  SELECT conv_id, i, x, CASE WHEN len(h) = 0 OR len(r) = 0 THEN {ignored} WHEN i < r[1] THEN {ignored}
    WHEN len(list_filter(range(1, least(len(h), len(r)) + 1), lambda j: i >= h[j] AND i < r[j])) > 0 THEN {ignored}
    WHEN len(h) > len(r) AND i >= h[len(h)] THEN {ignored} ELSE x END AS label
  FROM (SELECT conv_id, h, r, unnest(ids) AS x, unnest(range(len(ids))) AS i FROM marks))"""


_BY_WORDS = _completion_sql(t.words_sql("text"), [USER], [ASSISTANT])
_BY_BYTES = _completion_sql(t.bytes_sql("text"), list(USER.encode()), list(ASSISTANT.encode()))
_LABEL_ROW = "SELECT conv_id, string_agg(CAST(label AS VARCHAR), ' ' ORDER BY i) AS labels FROM labelled GROUP BY conv_id"


def _chat_labels(spark, sf, tokenizer=WORDS):
    rendered = render_conversation(t.conversations(spark, sf))
    ids = tokenize(rendered, "text", ["conv_id"], tokenizer)
    if tokenizer is WORDS:
        return m.completion_labels(ids, [USER], [ASSISTANT])
    return m.completion_labels(ids, list(USER.encode()), list(ASSISTANT.encode()))


@R.add("completion_labels", f"WITH {_BY_WORDS} {_LABEL_ROW}")
def _(spark, sf):
    return _chat_labels(spark, sf).select("conv_id", t.joined("labels").alias("labels"))


@R.add("completion_labels_bytes", f"WITH {_BY_BYTES} {_LABEL_ROW}")
def _(spark, sf):
    return _chat_labels(spark, sf, BYTES).select("conv_id", t.joined("labels").alias("labels"))


@R.add(
    "next_token_pairs",
    f"""WITH {_BY_WORDS}, shifted AS (SELECT conv_id, i AS pos, x AS token,
  lead(label) OVER (PARTITION BY conv_id ORDER BY i) AS label FROM labelled)
SELECT conv_id, CAST(pos AS INTEGER) AS pos, token, label FROM shifted WHERE label IS NOT NULL AND label <> '-100'""",
)
def _(spark, sf):
    return m.next_token_pairs(_chat_labels(spark, sf), ["conv_id"])


@R.add(
    "supervised_token_count",
    f"""WITH {_BY_WORDS} SELECT conv_id,
  CAST(count(*) FILTER (i > 0 AND label <> '-100') AS INTEGER) AS supervised_tokens FROM labelled GROUP BY conv_id""",
)
def _(spark, sf):
    return m.supervised_token_count(_chat_labels(spark, sf), ["conv_id"])


@R.add(
    "sft_examples",
    f"""WITH {t.INSTRUCT_SQL}, r AS (SELECT conv_id, turn, ({t.words_sql(
        t.exchange_sql(t.strip_sql("prompt"), t.strip_sql("response")))})[1:96] AS ids FROM instruct), p AS (
  SELECT conv_id, turn, ids, list_position(ids, '{ASSISTANT}') AS a FROM r)
SELECT conv_id, turn, array_to_string(ids, ' ') AS input_ids, rtrim(repeat('1 ', len(ids))) AS attention_mask,
  array_to_string(list_transform(ids, lambda x, i: CASE WHEN a IS NULL OR a = 0 OR i <= a THEN '-100' ELSE x END), ' ') AS labels
FROM p""",
)
def _(spark, sf):
    keep = ["conv_id", "turn"]
    rendered = sft_dataset({"chat": t.instruct(spark, sf)}, keep)
    examples = sft_examples(rendered, keep, 96, [USER], [ASSISTANT])
    return examples.select(
        *keep, *[t.joined(c).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )


# A mask with holes: real where the word has more than three characters.
_MASK = f"masks AS (SELECT doc_id, list_transform(ids, lambda x: CASE WHEN length(x) > 3 THEN 1 ELSE 0 END) AS mask FROM words)"


def _masks(spark, sf):
    long_word = F.transform("input_ids", lambda x: F.when(F.length(x) > 3, 1).otherwise(0))
    return _doc_words(spark, sf).select("doc_id", long_word.alias("attention_mask"))


@R.add(
    "position_ids",
    f"""WITH {_WORDS}, {_MASK}, flat AS (SELECT doc_id, unnest(mask) AS k, unnest(range(len(mask))) AS i FROM masks), p AS (
  SELECT doc_id, i, CASE WHEN k = 0 THEN 1 ELSE sum(k) OVER (PARTITION BY doc_id ORDER BY i) - 1 END AS pos FROM flat)
SELECT doc_id, string_agg(CAST(CAST(pos AS BIGINT) AS VARCHAR), ' ' ORDER BY i) AS position_ids FROM p GROUP BY doc_id""",
)
def _(spark, sf):
    placed = m.position_ids(_masks(spark, sf))
    return placed.select("doc_id", t.joined("position_ids").alias("position_ids"))


@R.add(
    "sequence_offsets",
    f"""WITH {_WORDS}, {_MASK}, rows AS (
  SELECT doc_id, mask, row_number() OVER (ORDER BY doc_id) - 1 AS rn, CAST(list_sum(mask) AS BIGINT) AS seqlen FROM masks), b AS (
  SELECT *, rn // 64 AS batch_id, rn % 64 AS batch_row FROM rows)
SELECT doc_id, batch_id, batch_row, seqlen,
  CAST(sum(seqlen) OVER w - seqlen AS BIGINT) AS start_offset, CAST(sum(seqlen) OVER w AS BIGINT) AS end_offset,
  CAST(max(seqlen) OVER (PARTITION BY batch_id) AS BIGINT) AS max_seqlen,
  array_to_string(list_transform(list_filter(range(len(mask)), lambda i: mask[i + 1] = 1), lambda i: batch_row * len(mask) + i), ' ') AS flat_indices
FROM b WINDOW w AS (PARTITION BY batch_id ORDER BY rn)""",
)
def _(spark, sf):
    offsets = m.sequence_offsets(_masks(spark, sf), "doc_id", 64)
    return offsets.withColumn("flat_indices", t.joined("flat_indices"))


@R.add(
    "last_valid_index",
    f"""WITH {_WORDS} SELECT doc_id, CAST(CASE WHEN p IS NULL OR p = 0 THEN len(ids) - 1
  ELSE (p - 2 + len(ids)) % len(ids) END AS INTEGER) AS last_index
FROM (SELECT doc_id, ids, list_position(ids, 'the') AS p FROM words)""",
)
def _(spark, sf):
    return m.last_valid_index(_doc_words(spark, sf), "the").select("doc_id", "last_index")
