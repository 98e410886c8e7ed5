"""Dialogue context, preference rows and rewards."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.tokenizers import BYTES
from corpusloom.operators import dialogue as d
from corpusloom.operators.ordering import order_key
from corpusloom.queries import Registry
from corpusloom.queries import tables as t

R = Registry({}, {})
KEY = ["conv_id", "turn"]
MAX_INPUT = 300

_FACTS = """facts AS (
  SELECT conv_id, n_turns, last_turn, off, last_role = 'user' AND (n_turns - off) % 2 = 1 AND good AS valid FROM (
    SELECT conv_id, count(*) AS n_turns, max(turn) AS last_turn, max(f.off) AS off, arg_max(role, turn) AS last_role,
      bool_and(turn < f.off OR role = CASE WHEN (turn - f.off) % 2 = 0 THEN 'user' ELSE 'assistant' END) AS good
    FROM conversations JOIN (
      SELECT conv_id, max(CASE WHEN turn = 0 AND role = 'system' THEN 1 ELSE 0 END) AS off
      FROM conversations GROUP BY conv_id) f USING (conv_id) GROUP BY conv_id)), turns AS (
  SELECT c.*, f.off, f.last_turn, f.n_turns, (c.turn - f.off) // 2 AS exchange,
    CASE WHEN c.turn < f.off THEN 'system' WHEN c.turn = f.last_turn THEN 'query' ELSE 'history' END AS kind
  FROM conversations c JOIN facts f USING (conv_id) WHERE f.valid)"""


@R.add("dialogue_valid", f"WITH {_FACTS} SELECT conv_id, n_turns, valid FROM facts")
def _(spark, sf):
    return d.dialogue_valid(t.conversations(spark, sf))


@R.add(
    "parse_dialogue",
    f"""WITH {_FACTS} SELECT conv_id, kind, CASE WHEN kind <> 'system' THEN exchange END AS exchange,
  max(text) FILTER (role <> 'assistant') AS user, max(text) FILTER (role = 'assistant') AS assistant
FROM turns GROUP BY ALL""",
)
def _(spark, sf):
    return d.parse_dialogue(t.conversations(spark, sf))


_MARK = "CASE WHEN kind = 'system' THEN '<|system|>' WHEN role = 'user' THEN '<|user|>' ELSE '<|assistant|>' END"
_BUDGET = f"""{_FACTS}, pieces AS (
  SELECT *, {_MARK} || chr(10) || {t.strip_sql("text")} AS piece FROM turns), counted AS (
  SELECT *, len({t.words_sql("piece")}) AS n FROM pieces), budgets AS (
  SELECT conv_id, {MAX_INPUT} - sum(CASE WHEN kind <> 'history' THEN n ELSE 0 END)
    - max(CASE WHEN off = 0 THEN 6 ELSE 0 END) - 1 AS budget FROM counted GROUP BY conv_id), exchanges AS (
  SELECT conv_id, exchange, sum(n) AS num_tokens FROM counted WHERE kind = 'history' GROUP BY ALL), running AS (
  SELECT *, sum(num_tokens) OVER (PARTITION BY conv_id ORDER BY exchange DESC) AS cum_tokens FROM exchanges), fitting AS (
  SELECT conv_id, exchange, CAST(num_tokens AS BIGINT) AS num_tokens, CAST(cum_tokens AS BIGINT) AS cum_tokens,
    CAST(budget AS BIGINT) AS budget FROM running JOIN budgets USING (conv_id) WHERE cum_tokens < budget)"""


@R.add(
    "history_budget",
    f"WITH {_BUDGET} SELECT conv_id, exchange, num_tokens, cum_tokens, budget FROM fitting",
)
def _(spark, sf):
    return d.history_budget(t.conversations(spark, sf), MAX_INPUT)


@R.add(
    "build_context",
    f"""WITH {_BUDGET} SELECT p.conv_id, max(CASE WHEN off = 0
    THEN '<|system|>' || chr(10) || '{d.DEFAULT_SYSTEM}' || chr(10) ELSE '' END)
  || coalesce(string_agg(piece || chr(10), '' ORDER BY turn), '') || '<|assistant|>' || chr(10) AS context
FROM pieces p LEFT JOIN fitting f ON f.conv_id = p.conv_id AND f.exchange = p.exchange AND p.kind = 'history'
WHERE p.kind <> 'history' OR f.conv_id IS NOT NULL GROUP BY p.conv_id""",
)
def _(spark, sf):
    return d.build_context(t.conversations(spark, sf), MAX_INPUT)


@R.add(
    "build_context_ids",
    f"""WITH {_BUDGET}, met AS (
  SELECT p.conv_id, p.off, p.turn, p.piece FROM pieces p LEFT JOIN fitting f ON f.conv_id = p.conv_id AND f.exchange = p.exchange
    AND p.kind = 'history' WHERE p.kind <> 'history' OR f.conv_id IS NOT NULL), ids AS (
  SELECT conv_id, CASE WHEN max(off) = 0 THEN {t.words_sql(f"'<|system|> {d.DEFAULT_SYSTEM}'")} ELSE [] END
    || flatten(list({t.words_sql("piece")} ORDER BY turn)) || ['<|assistant|>'] AS ids FROM met GROUP BY conv_id)
SELECT conv_id, array_to_string(ids, ' ') AS input_ids, CAST(len(ids) AS INTEGER) AS num_tokens FROM ids""",
)
def _(spark, sf):
    found = d.build_context_ids(t.conversations(spark, sf), MAX_INPUT)
    return found.withColumn("input_ids", t.joined("input_ids"))


_BYTES = f"""counted AS (
  SELECT conv_id, exchange, kind, off, octet_length(encode({_MARK} || chr(10) || {t.strip_sql("text")})) + 1 AS n FROM turns),
  budgets AS (SELECT conv_id, 6000 - sum(CASE WHEN kind <> 'history' THEN n ELSE 0 END)
    - max(CASE WHEN off = 0 THEN {len(d.SYSTEM_MARK) + len(d.DEFAULT_SYSTEM) + 2} ELSE 0 END) - {len(d.ASSISTANT_MARK) + 1} AS budget
    FROM counted GROUP BY conv_id), running AS (
  SELECT conv_id, exchange, sum(n) AS num_tokens, sum(sum(n)) OVER (PARTITION BY conv_id ORDER BY exchange DESC) AS cum_tokens
  FROM counted WHERE kind = 'history' GROUP BY conv_id, exchange)"""


@R.add(
    "history_budget_bytes",
    f"""WITH {_FACTS}, {_BYTES} SELECT conv_id, exchange, CAST(num_tokens AS BIGINT) AS num_tokens,
  CAST(cum_tokens AS BIGINT) AS cum_tokens, CAST(budget AS BIGINT) AS budget
FROM running JOIN budgets USING (conv_id) WHERE cum_tokens < budget""",
)
def _(spark, sf):
    return d.history_budget(t.conversations(spark, sf), 6000, tokenizer=BYTES)


def _pairs(spark, sf):
    return t.instruct(spark, sf).select(
        *KEY, "prompt", F.col("response").alias("chosen"), F.substring("response", 1, 40).alias("rejected")
    )


def _pair_sql(answer: str, name: str) -> str:
    """The last 48 tokens of the last 24 of the prompt and an answer, and which are the answer's."""
    ids = f"list_concat(p, {answer})"
    mask = f"list_concat(list_transform(p, lambda x: 0), list_transform({answer}, lambda x: 1))"
    return ", ".join(
        f"array_to_string(({v})[greatest(len({ids}) - 48, 0) + 1:], ' ') AS {name}_{what}" for v, what in ((ids, "ids"), (mask, "mask"))
    )


@R.add(
    "preference_pairs",
    f"""WITH {t.INSTRUCT_SQL}, words AS (SELECT conv_id, turn, {t.words_sql("prompt")} AS w, {t.words_sql("response")} AS c,
  {t.words_sql("substr(response, 1, 40)")} AS r FROM instruct), cut AS (
  SELECT conv_id, turn, c, r, w[greatest(len(w) - 24, 0) + 1:] AS p FROM words)
SELECT conv_id, turn, {_pair_sql("c", "chosen")}, {_pair_sql("r", "rejected")} FROM cut""",
)
def _(spark, sf):
    rows = d.preference_pairs(_pairs(spark, sf), KEY, 48, max_prompt=24)
    names = ("chosen_ids", "chosen_mask", "rejected_ids", "rejected_mask")
    return rows.select(*KEY, *[t.joined(c).alias(c) for c in names])


@R.add(
    "preference_rows",
    f"""WITH {t.INSTRUCT_SQL} SELECT conv_id, turn, array_to_string({t.words_sql("prompt")}[1:32], ' ') AS prompt_ids,
  array_to_string({t.words_sql("response")}[1:32], ' ') AS chosen_ids,
  array_to_string({t.words_sql("substr(response, 1, 40)")}[1:32], ' ') AS rejected_ids FROM instruct""",
)
def _(spark, sf):
    pairs = t.instruct(spark, sf).select(
        *KEY,
        "prompt",
        F.col("response").alias("chosen"),
        F.substring("response", 1, 40).alias("rejected"),
    )
    rows = d.preference_rows(pairs, KEY, 32)
    return rows.select(
        *KEY, *[t.joined(c).alias(c) for c in ("prompt_ids", "chosen_ids", "rejected_ids")]
    )


@R.add(
    "preference_text",
    f"""WITH {t.INSTRUCT_SQL} SELECT conv_id, turn,
  {t.turn_sql("'user'", "prompt")} || '<|im_start|>assistant' || chr(10) AS prompt,
  response || '<|im_end|>' || chr(10) AS chosen, substr(response, 1, 40) || '<|im_end|>' || chr(10) AS rejected
FROM instruct""",
)
def _(spark, sf):
    def one(role, content):
        return F.array(F.struct(F.lit(role).alias("role"), content.alias("content")))

    pairs = t.instruct(spark, sf).select(
        *KEY,
        one("user", F.col("prompt")).alias("prompt"),
        one("assistant", F.col("response")).alias("chosen"),
        one("assistant", F.substring("response", 1, 40)).alias("rejected"),
    )
    return d.preference_text(pairs, KEY)


@R.add(
    "query_response_text",
    f"WITH {t.INSTRUCT_SQL} SELECT conv_id, turn, prompt || response AS text FROM instruct",
)
def _(spark, sf):
    return d.query_response_text(t.instruct(spark, sf), KEY, query="prompt")


@R.add(
    "length_reward",
    f"WITH {t.INSTRUCT_SQL} SELECT conv_id, turn, CAST(length(response) AS INTEGER) AS reward FROM instruct",
)
def _(spark, sf):
    return d.length_reward(t.instruct(spark, sf)).select(*KEY, "reward")


@R.add(
    "reward_stats",
    f"""WITH {t.INSTRUCT_SQL}, r AS (SELECT length(response) AS reward,
  (row_number() OVER (ORDER BY conv_id, turn) - 1) // 32 AS batch_id FROM instruct)
SELECT batch_id, count(*) AS num_rows, round(avg(reward), 6) AS mean_reward, round(stddev_samp(reward), 6) AS std_reward,
  CAST(min(reward) AS INTEGER) AS min_reward, CAST(max(reward) AS INTEGER) AS max_reward FROM r GROUP BY batch_id""",
)
def _(spark, sf):
    rewards = d.length_reward(t.instruct(spark, sf)).withColumn("key", order_key("conv_id", "turn"))
    return d.reward_stats(rewards, "key", 32).withColumns(
        {c: F.round(c, 6) for c in ("mean_reward", "std_reward")}
    )
