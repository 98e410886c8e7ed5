"""Dialogue, preference and reward tables.

Dialogues come as a long table ``(conv_id, turn, role, text)`` with turns counted from
0. One conversation may be arbitrarily long, so nothing here groups or joins on
``conv_id`` alone before the rows are bounded: facts about a conversation are numeric
aggregates (combined before the shuffle), they are joined back on ``(conv_id, chunk)``
with ``CHUNK_TURNS`` turns per chunk, and context windows first drop turns that cannot fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import chatml
from corpusloom.functions.arrays import let
from corpusloom.functions.text import str_strip
from corpusloom.functions.tokenizers import WORDS
from corpusloom.operators.ordering import plan_segments
from corpusloom.operators.tokens import truncate

CHUNK_TURNS = 1024
CHUNK_EXCHANGES = 512
DEFAULT_SYSTEM = "You are a helpful assistant."

# Markup of the dialogue context form.
SYSTEM_MARK = "<|system|>"
USER_MARK = "<|user|>"
ASSISTANT_MARK = "<|assistant|>"


def _chunk() -> Column:
    return F.call_function("div", F.col("turn").cast("bigint"), F.lit(CHUNK_TURNS).cast("bigint"))


def dialogue_facts(turns: DataFrame) -> DataFrame:
    """Per conversation: ``last_turn``, ``n_turns``, ``offset`` (1 if it opens with a
    system message) and ``valid``.

    Valid means: the last message is from the user, and those before it, after an
    optional system message, are user/assistant exchanges.
    """
    turn, role = F.col("turn").cast("bigint"), F.col("role")
    odd = turn % 2 == 1
    # A system message shifts the user's turns from even to odd places.
    not_user, not_assistant = ~role.eqNullSafe("user"), ~role.eqNullSafe("assistant")
    if_plain = F.when(odd, not_assistant).otherwise(not_user)
    if_system = F.when(odd, not_user).otherwise(not_assistant & (turn > 0))
    is_user = F.when(role == "user", F.lit(1)).otherwise(0)
    facts = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        # Turn and role of the last message in one number, so that the aggregate keeps
        # to fixed-width values.
        F.max(turn * 2 + is_user).alias("_last"),
        F.max(F.when((turn == 0) & (role == "system"), 1).otherwise(0)).alias("offset"),
        F.sum(if_plain.cast("int")).alias("_bad_plain"),
        F.sum(if_system.cast("int")).alias("_bad_system"),
    )
    bad = F.when(F.col("offset") == 1, F.col("_bad_system")).otherwise(F.col("_bad_plain"))
    last_turn = F.shiftright("_last", 1)
    return facts.select(
        "conv_id",
        "n_turns",
        last_turn.alias("last_turn"),
        "offset",
        (
            (F.col("_last") % 2 == 1)
            & ((F.col("n_turns") - F.col("offset")) % 2 == 1)
            & (F.col("n_turns") == last_turn + 1)
            & (bad == 0)
        ).alias("valid"),
    )


def dialogue_valid(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, valid)``; bad dialogues are marked, never an error."""
    return dialogue_facts(turns).select("conv_id", "n_turns", "valid")


def with_facts(turns: DataFrame) -> DataFrame:
    """Turns with their conversation's facts. A conversation of n chunks gets n copies of
    its one-row facts, so the join key of a long conversation is spread."""
    placed = turns.withColumn("chunk", _chunk())
    met = placed.select(F.col("conv_id").alias("_conv"), F.col("chunk").alias("_part")).distinct()
    facts = dialogue_facts(turns).join(met, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("conv_id")
    own = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("chunk").eqNullSafe(F.col("_part"))
    return placed.join(facts, own).drop("_conv", "_part")


def render_conversation(
    turns: DataFrame, system: str | None = None, think_on_last: bool = True
) -> DataFrame:
    """``(conv_id, text)``: ChatML of whole conversations, one row each, whatever their length.

    Turns become text by chunk first, then the chunks' texts are joined up. Turns without a number
    come first; turns without a conversation are one conversation.
    """
    think = (F.col("role") == "assistant") & (F.col("turn") == F.col("last_turn")) & F.lit(
        think_on_last
    )
    rendered = with_facts(turns).select(
        "conv_id", "chunk", "turn", chatml.render_turn(F.col("role"), F.col("text"), think).alias("_t")
    )
    in_order = F.array_sort(F.collect_list(F.struct("turn", "_t")))
    text = F.array_join(F.transform(in_order, lambda m: m["_t"]), "")
    if system is not None:
        head = chatml.render_turn(F.lit("system"), F.lit(system))
    chunks = rendered.groupBy("conv_id", "chunk").agg(text.alias("text"))
    whole = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda c: c["text"]), ""
    )
    if system is not None:
        whole = F.concat(head, whole)
    return chunks.groupBy("conv_id").agg(whole.alias("text"))


def exchanges(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it: ``(conv_id, turn, prompt,
    response)``. Joined on (conv_id, turn), which no long conversation can skew."""
    turn = F.col("turn").cast("bigint")
    users = turns.where("role = 'user'").select(
        "conv_id", turn.alias("turn"), F.col("text").alias("prompt")
    )
    answers = turns.where("role = 'assistant'").select(
        "conv_id", (turn - 1).alias("turn"), F.col("text").alias("response")
    )
    return users.join(answers, ["conv_id", "turn"])


def _place() -> Column:
    return (
        F.when((F.col("turn") == 0) & (F.col("offset") == 1), F.lit("system"))
        .when(F.col("turn") == F.col("last_turn"), F.lit("query"))
        .otherwise(F.lit("history"))
    )


def _exchange_number() -> Column:
    return F.call_function(
        "div", F.col("turn").cast("bigint") - F.col("offset"), F.lit(2).cast("bigint")
    )


def parse_dialogue(turns: DataFrame) -> DataFrame:
    """Valid dialogues as rows ``(conv_id, kind, exchange, user, assistant)``.

    ``kind`` is system (text in ``user``, exchange null), history (one row per exchange,
    counted from 0) or query. Grouped on (conv_id, kind, exchange): two rows at most.
    """
    placed = with_facts(turns).where("valid").withColumn("kind", _place())
    return (
        placed.withColumn(
            "exchange", F.when(F.col("kind") != "system", _exchange_number())
        )
        .groupBy("conv_id", "kind", "exchange")
        .agg(
            F.max(F.when(F.col("role") != "assistant", F.col("text"))).alias("user"),
            F.max(F.when(F.col("role") == "assistant", F.col("text"))).alias("assistant"),
        )
    )


def _marked(mark: str, text: Column) -> Column:
    return F.concat(F.lit(mark + "\n"), str_strip(text))


def _context_turns(turns: DataFrame, max_input: int, system: str, tokenizer) -> DataFrame:
    """Turns of valid dialogues that may enter the context, with ``budget`` and ``cum_tokens``.

    Where the two marks of an exchange cost a token, only the last ``max_input`` exchanges of a
    dialogue can be kept, and older turns go first. Where they cost none, every turn is counted.
    Running totals are taken in two levels: sums of ``CHUNK_EXCHANGES`` exchanges each, a running sum over
    these, and one inside each chunk. So the turns of a long conversation are never in one window.
    """
    newline = tokenizer.count(F.lit("\n"))
    least = tokenizer.count(F.lit(USER_MARK)) + tokenizer.count(F.lit(ASSISTANT_MARK)) + newline
    near_end = (F.col("turn") > F.col("last_turn") - 1 - 2 * max_input) | (least == 0)
    mark = F.when(F.col("kind") == "system", F.lit(SYSTEM_MARK)).when(
        F.col("role") == "user", F.lit(USER_MARK)
    ).otherwise(F.lit(ASSISTANT_MARK))
    # An empty system text counts as none given.
    chosen = F.when(
        (F.col("kind") == "system") & (F.col("text") == ""), F.lit(system)
    ).otherwise(F.col("text"))
    rows = (
        with_facts(turns)
        .where("valid")
        .withColumn("kind", _place())
        .where((F.col("kind") != "history") | near_end)
        .where((F.col("kind") != "system") | (chosen != ""))
        .withColumn("exchange", _exchange_number())
        .withColumn("part", F.call_function("div", F.col("exchange"), F.lit(CHUNK_EXCHANGES).cast("bigint")))
        .withColumn("piece", F.concat(mark, F.lit("\n"), str_strip(chosen)))
        .withColumn("n", (tokenizer.count("piece") + newline).cast("bigint"))
    )
    added = F.when(F.col("offset") == 1, F.lit(0)).otherwise(
        (tokenizer.count(_marked(SYSTEM_MARK, F.lit(system))) + newline) if system else F.lit(0)
    )
    closing = tokenizer.count(F.lit(ASSISTANT_MARK)) + newline
    zero = F.lit(0).cast("bigint")
    history = F.when(F.col("kind") == "history", F.col("n")).otherwise(zero)
    other = F.when(F.col("kind") != "history", F.col("n")).otherwise(zero)
    parts = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("part").alias("_part")).agg(
        F.sum(history).alias("_history"), F.sum(other).alias("_other")
    )
    whole = W.partitionBy("_conv")
    newer = whole.orderBy(F.col("_part").desc()).rowsBetween(W.unboundedPreceding, -1)
    totals = parts.select(
        "_conv", "_part", F.coalesce(F.sum("_history").over(newer), zero).alias("_newer"), F.sum("_other").over(whole).alias("_fixed")
    )
    own = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    newest_first = W.partitionBy("conv_id", "part").orderBy(F.col("exchange").desc()).rangeBetween(W.unboundedPreceding, 0)
    return (
        rows.join(totals, own)
        .withColumn("budget", F.lit(max_input) - F.col("_fixed") - added - closing)
        .withColumn("cum_tokens", F.col("_newer") + F.sum(history).over(newest_first))
        .drop("_conv", "_part", "_newer", "_fixed")
    )


def history_budget(
    turns: DataFrame, max_input: int, system: str = DEFAULT_SYSTEM, tokenizer=WORDS
) -> DataFrame:
    """Exchanges that fit, newest first: kept while their running total stays strictly
    below what system, query and the opened answer leave of ``max_input``.

    Totals only grow, so the filter stops where a loop with ``break`` would. A conversation of any length is spread
    over tasks by chunks of its exchanges.
    """
    return (
        _context_turns(turns, max_input, system, tokenizer)
        .where("kind = 'history' AND cum_tokens < budget")
        .groupBy("conv_id", "exchange")
        .agg(
            F.sum("n").alias("num_tokens"),
            F.max("cum_tokens").alias("cum_tokens"),
            F.max("budget").alias("budget"),
        )
    )


def _joined_pieces(placed: DataFrame, piece: Column, join) -> DataFrame:
    """``(conv_id, offset, joined)``: pieces in the order of turns, joined by chunk first, then the chunks."""
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("turn", piece.alias("p")))), lambda x: x["p"])
    chunks = (
        placed.where((F.col("kind") != "history") | (F.col("cum_tokens") < F.col("budget")))
        .groupBy("conv_id", "part")
        .agg(join(in_order).alias("joined"), F.max("offset").alias("offset"), F.min("turn").alias("first"))
    )
    whole = F.transform(F.array_sort(F.collect_list(F.struct("first", "joined"))), lambda x: x["joined"])
    return chunks.groupBy("conv_id").agg(join(whole).alias("joined"), F.max("offset").alias("offset"))


def build_context(
    turns: DataFrame, max_input: int, system: str = DEFAULT_SYSTEM, tokenizer=WORDS
) -> DataFrame:
    """``(conv_id, context)`` of valid dialogues: system, kept history, query, opened
    assistant turn, each closed by a newline."""
    placed = _context_turns(turns, max_input, system, tokenizer)
    head = F.concat(_marked(SYSTEM_MARK, F.lit(system)), F.lit("\n")) if system else F.lit("")
    joined = _joined_pieces(placed, F.concat("piece", F.lit("\n")), lambda texts: F.array_join(texts, ""))
    text = F.concat(
        F.when(F.col("offset") == 0, head).otherwise(F.lit("")), F.col("joined"), F.lit(ASSISTANT_MARK + "\n")
    )
    return joined.select("conv_id", text.alias("context"))


def build_context_ids(
    turns: DataFrame, max_input: int, system: str = DEFAULT_SYSTEM, tokenizer=WORDS
) -> DataFrame:
    """``(conv_id, input_ids, num_tokens)``: the context as tokens, fewer than ``max_input`` of history and all the rest.

    Each message is tokenized by itself with its mark, and the newline after it by itself, as the budget counts them,
    so no token spans two messages. The tokens of :func:`build_context`'s text may be others.
    """
    placed = _context_turns(turns, max_input, system, tokenizer)
    newline = tokenizer.tokens(F.lit("\n"))

    def message(text) -> Column:
        return F.concat(tokenizer.tokens(text), newline)

    joined = _joined_pieces(placed, message(F.col("piece")), F.flatten)
    closing = F.concat(F.col("joined"), message(F.lit(ASSISTANT_MARK)))
    if system:
        opening = message(_marked(SYSTEM_MARK, F.lit(system)))
        closing = F.when(F.col("offset") == 0, F.concat(opening, closing)).otherwise(closing)
    ids = joined.select("conv_id", closing.alias("input_ids"))
    return ids.withColumn("num_tokens", F.array_size("input_ids"))


def preference_text(
    df: DataFrame,
    keep: list[str],
    prompt: str = "prompt",
    chosen: str = "chosen",
    rejected: str = "rejected",
) -> DataFrame:
    """Preference data as three strings, from strings or from message arrays.

    Of messages, the prompt is rendered up to the opened assistant turn, and an answer is
    what a rendering adds behind that opening.
    """
    opening = f"{chatml.TURN_START}assistant\n"

    def side(name: str, is_prompt: bool) -> Column:
        if df.schema[name].dataType.simpleString() == "string":
            return F.col(name)
        if is_prompt:
            return chatml.generation_prompt(name)
        rendered = chatml.render_messages(name, think_on_last=False)
        return F.substr(rendered, F.lit(len(opening) + 1))

    return df.select(
        *keep,
        side(prompt, True).alias("prompt"),
        side(chosen, False).alias("chosen"),
        side(rejected, False).alias("rejected"),
    )


def preference_rows(
    df: DataFrame,
    keep: list[str],
    max_length: int,
    prompt: str = "prompt",
    chosen: str = "chosen",
    rejected: str = "rejected",
    tokenizer=WORDS,
) -> DataFrame:
    """Preference data as ``prompt_ids, chosen_ids, rejected_ids``, each cut to length."""
    texts = preference_text(df, keep, prompt, chosen, rejected)
    names = {"prompt_ids": "prompt", "chosen_ids": "chosen", "rejected_ids": "rejected"}
    out = texts.select(*keep, *[tokenizer.tokens(c).alias(n) for n, c in names.items()])
    for name in names:
        out = truncate(out, max_length, name)
    return out


def preference_pairs(
    df: DataFrame,
    keep: list[str],
    max_length: int,
    max_prompt: int | None = None,
    keep_end: bool = True,
    prompt: str = "prompt",
    chosen: str = "chosen",
    rejected: str = "rejected",
    tokenizer=WORDS,
) -> DataFrame:
    """Preference data as the two sequences a model is trained on: ``chosen_ids, chosen_mask, rejected_ids,
    rejected_mask``, each the prompt followed by the answer, of which ``max_length`` tokens are kept.

    ``keep_end`` keeps the last tokens of the pair, so a long prompt loses its front; else the first, so that a
    long answer loses its end. ``max_prompt`` cuts the prompt by the same rule beforehand. The mask is 1 on the answer's
    tokens and 0 on the prompt's. A null text makes its sequences null.
    """
    texts = preference_text(df, keep, prompt, chosen, rejected)
    tokens = texts.select(*keep, *[tokenizer.tokens(c).alias(c) for c in ("prompt", "chosen", "rejected")])

    def capped(values: Column, most: int) -> Column:
        n = F.array_size(values)
        return F.slice(values, F.greatest(n - most, F.lit(0)) + 1 if keep_end else F.lit(1), F.least(n, F.lit(most)))

    if max_prompt is not None:
        tokens = tokens.withColumn("prompt", capped(F.col("prompt"), max_prompt))

    def side(name: str) -> list[Column]:
        marks = [F.array_repeat(F.lit(v), F.array_size(c)) for v, c in ((0, "prompt"), (1, name))]
        return [
            let(F.concat("prompt", name), lambda ids: capped(ids, max_length)).alias(f"{name}_ids"),
            let(F.concat(*marks), lambda mask: capped(mask, max_length)).alias(f"{name}_mask"),
        ]

    return tokens.select(*keep, *side("chosen"), *side("rejected"))


def query_response_text(
    df: DataFrame, keep: list[str], query: str = "query", response: str = "response"
) -> DataFrame:
    """Query directly followed by response."""
    return df.select(*keep, F.concat(query, response).alias("text"))


def length_reward(df: DataFrame, response: str = "response") -> DataFrame:
    """The stand-in reward: number of characters of the response."""
    return df.withColumn("reward", F.length(response))


def reward_stats(
    df: DataFrame,
    order: str,
    batch_rows: int,
    reward: str = "reward",
) -> DataFrame:
    """Reward statistics per batch of consecutive rows. Only key and reward move."""
    plan = plan_segments(df, order, batch_rows)
    numbered = plan.attach(df.select(order, reward), plan.places.select("segment", order, "batch_id"))
    return (
        numbered.groupBy(*plan.batch_keys)
        .agg(
            F.count(F.lit(1)).alias("num_rows"),
            F.avg(reward).alias("mean_reward"),
            F.stddev_samp(reward).alias("std_reward"),
            F.min(reward).alias("min_reward"),
            F.max(reward).alias("max_reward"),
        )
        .drop("segment")
    )
