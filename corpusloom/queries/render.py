"""Prompt and chat rendering."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import render
from corpusloom.operators.dialogue import DEFAULT_SYSTEM, render_conversation
from corpusloom.plans.finetune import sft_dataset
from corpusloom.queries import Registry
from corpusloom.queries import tables as t

R = Registry({}, {})
KEY = ["conv_id", "turn"]

_PAIR = t.exchange_sql(t.strip_sql("prompt"), t.strip_sql("response"))
_INSTRUCT = f"WITH {t.INSTRUCT_SQL} SELECT conv_id, turn, {{text}} AS text FROM instruct"


@R.add(
    "instruction_prompt",
    f"""WITH {t.INSTRUCT_SQL} SELECT u.conv_id, u.turn, '### Instruction:' || chr(10) || u.text || chr(10)
  || '### Response:' || chr(10) || coalesce(a.response, 'None') AS text
FROM conversations u LEFT JOIN instruct a ON a.conv_id = u.conv_id AND a.turn = u.turn WHERE u.role = 'user'""",
)
def _(spark, sf):
    # Users without an answer keep a null response, which prints as None.
    users = t.conversations(spark, sf).where("role = 'user'")
    rows = users.join(t.instruct(spark, sf).select(*KEY, "response"), KEY, "left")
    return render.instruction_prompt(rows.withColumnRenamed("text", "prompt"), KEY)


@R.add("chat_prompt_response", _INSTRUCT.format(text=_PAIR))
def _(spark, sf):
    return render.chat_prompt_response(t.instruct(spark, sf), KEY)


@R.add("chat_input_target", _INSTRUCT.format(text=_PAIR))
def _(spark, sf):
    rows = t.instruct(spark, sf).withColumnsRenamed({"prompt": "input", "response": "target"})
    return render.chat_input_target(rows, KEY)


@R.add("chat_first_exchange", _INSTRUCT.format(text=t.exchange_sql("prompt", "response")))
def _(spark, sf):
    rows = t.instruct(spark, sf).select(
        *KEY,
        F.array(
            F.struct(F.col("prompt").alias("value")), F.struct(F.col("response").alias("value"))
        ).alias("conversations"),
    )
    return render.chat_first_exchange(rows, KEY)


@R.add(
    "chat_first_exchange_rejects",
    f"""WITH {t.INSTRUCT_SQL} SELECT u.conv_id, u.turn FROM conversations u
WHERE u.role = 'user' AND NOT EXISTS (SELECT 1 FROM instruct i WHERE i.conv_id = u.conv_id AND i.turn = u.turn)""",
)
def _(spark, sf):
    users = t.conversations(spark, sf).where("role = 'user'")
    rows = users.join(t.instruct(spark, sf).select(*KEY, "response"), KEY, "left")
    asked = F.struct(F.col("text").alias("value"))
    both = F.array(asked, F.struct(F.col("response").alias("value")))
    shaped = rows.select(
        *KEY, F.when(F.col("response").isNull(), F.array(asked)).otherwise(both).alias("conversations")
    )
    lenient = render.chat_first_exchange(shaped, KEY, strict=False)
    return render.unrendered(lenient).select(*KEY)


_FIRST = t.turn_sql("'user'", t.strip_sql("i.prompt")) + " || " + "'<|im_start|>assistant' || chr(10)"


@R.add(
    "chat_multi_turn",
    f"""WITH {t.INSTRUCT_SQL}, marked AS (SELECT *, row_number() OVER (
  PARTITION BY conv_id ORDER BY turn DESC, prompt DESC, response DESC) = 1 AS is_last FROM instruct)
SELECT conv_id, string_agg({_FIRST} || CASE WHEN is_last THEN {t.THINK_SQL} ELSE '' END
  || {t.strip_sql("i.response")} || '<|im_end|>' || chr(10), '' ORDER BY turn, prompt, response) AS text
FROM marked i GROUP BY conv_id""",
)
def _(spark, sf):
    # All exchanges of a conversation, in the array that the operator reads.
    item = F.struct(F.col("prompt").alias("human"), F.col("response").alias("assistant"))
    gathered = t.instruct(spark, sf).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", item.alias("item")))).alias("items")
    )
    shaped = gathered.select("conv_id", F.transform("items", lambda x: x["item"]).alias("conversation"))
    return render.chat_multi_turn(shaped, ["conv_id"])


@R.add(
    "chat_instruction_input",
    _INSTRUCT.format(
        text=t.exchange_sql(
            f"{t.strip_sql('prompt')} || chr(10) || {t.strip_sql('CAST(turn AS VARCHAR)')}",
            t.strip_sql("response"),
        )
    ),
)
def _(spark, sf):
    rows = t.instruct(spark, sf).select(
        *KEY,
        F.col("prompt").alias("instruction"),
        F.col("turn").cast("string").alias("input"),
        F.col("response").alias("output"),
    )
    return render.chat_instruction_input(rows, KEY)


@R.add(
    "with_system",
    _INSTRUCT.format(text=t.turn_sql("'system'", f"'{DEFAULT_SYSTEM}'") + " || " + _PAIR),
)
def _(spark, sf):
    return render.chat_prompt_response(t.instruct(spark, sf), KEY, system=DEFAULT_SYSTEM)


@R.add(
    "generation_prompt",
    f"""SELECT conv_id, turn, {t.turn_sql("'user'", "text")} || '<|im_start|>assistant' || chr(10) || {t.THINK_SQL}
  AS text FROM conversations WHERE role = 'user'""",
)
def _(spark, sf):
    users = t.conversations(spark, sf).where("role = 'user'")
    return render.generation_prompt(users, KEY, prompt="text", thinking=False)


@R.add(
    "render_conversation",
    f"WITH {t.RENDERED_SQL} SELECT conv_id, text FROM rendered",
)
def _(spark, sf):
    return render_conversation(t.conversations(spark, sf))


@R.add(
    "sft_dataset",
    f"""WITH {t.INSTRUCT_SQL} SELECT 'chat' AS source, 0 AS source_ord, conv_id, turn, {_PAIR} AS text
FROM instruct""",
)
def _(spark, sf):
    return sft_dataset({"chat": t.instruct(spark, sf)}, KEY)
