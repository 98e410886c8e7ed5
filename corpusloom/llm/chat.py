"""Formatting conversations of typed content parts (operator 4).

A message has parts: text, or an attachment (image, audio, document). Parts are visited in order:
text is written out escaped, an attachment becomes a numbered placeholder, and its reference,
the place of the placeholder and the tokens it stands for are recorded. The output marks turns

    ### <Role>: <content></turn>

and no text can forge a mark: ``\\``, ``<``, ``#`` (and ``:`` in roles) are escaped one by one by a
backslash and a letter, which contains none of them, so every escape can be undone.

Only DataFrame operations. A conversation is one output row, and one text, by its nature; what is
gathered for it is its own parts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURN_START, TURN_END = "### ", "</turn>\n"
PARTS = "array<struct<type:string,text:string,ref:string,units:bigint>>"
#: Tokens that one unit of an attachment stands for: an image tile, a second of audio, a page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"), ("\n", "\\n"))


def escape(text: Column, escapes: tuple = ESCAPES) -> Column:
    for plain, escaped in escapes:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column, escapes: tuple = ESCAPES) -> Column:
    """Undo :func:`escape`; the backslash comes last, when no other escape is left."""
    for plain, escaped in reversed(escapes):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def text_part(text: str) -> Column:
    """A message's plain text as its only part; null is empty."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("bigint").alias("units"),
    )
    return F.array(part).cast(PARTS)


def format_conversations(
    df: DataFrame,
    conv: str,
    turn: str,
    role: str,
    parts: str,
    unit_tokens: Mapping[str, int] = UNIT_TOKENS,
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``loss_spans`` (start and length in code
    points of what ``trained_role`` wrote), ``attachments`` (number, type, ref, tokens, start) and
    ``attachment_tokens``.

    Turns are ordered by number, nulls first, then role and content. Null roles and texts are
    empty, null or empty parts give an empty message, a part of unknown type is an error, null
    units count as one, a null conversation id is a conversation. Repeated rows are
    repeated turns. An empty table gives no rows; other columns are not read.
    """
    known = F.create_map(*[F.lit(x) for kv in unit_tokens.items() for x in kv])
    content = F.array_join(
        F.transform(F.coalesce(F.col(parts), F.array().cast(PARTS)), lambda p: F.coalesce(p["text"], p["ref"], F.lit(""))),
        "\n",
    )
    messages = df.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.when(F.size(parts) > 0, F.col(parts)).alias("parts"),
        content.alias("content"),
        F.monotonically_increasing_id().alias("row"),
    )
    visited = messages.select(
        "conv", "turn", "role", "content", "row",
        (F.greatest(F.size("parts"), F.lit(1)) - 1).alias("last"),
        F.posexplode_outer("parts").alias("pos", "part"),
    ).withColumn("pos", F.coalesce("pos", F.lit(0)))
    in_order = W.partitionBy("conv").orderBy("turn", "role", "content", "row", "pos")
    attached = F.col("part.type") != "text"
    number = F.sum(F.coalesce(attached, F.lit(False)).cast("int")).over(
        in_order.rowsBetween(W.unboundedPreceding, 0)
    )
    kind = F.col("part.type")
    placeholder = F.concat(F.lit("<|"), kind, F.lit("_"), number.cast("string"), F.lit("|>"))
    head = F.concat(F.lit(TURN_START), escape(F.col("role"), ROLE_ESCAPES), F.lit(": "))
    body = (
        F.when(F.col("part").isNull(), F.lit(""))
        .when(kind == "text", escape(F.coalesce("part.text", F.lit(""))))
        .when(F.element_at(known, kind).isNotNull(), placeholder)
        .otherwise(F.raise_error(F.concat(F.lit("unknown part type "), F.coalesce(kind, F.lit("null")))))
    )
    pieces = visited.select(
        "conv",
        F.row_number().over(in_order).alias("n"),
        F.when(F.col("pos") == 0, head).otherwise(F.lit("")).alias("head"),
        body.alias("body"),
        F.when(F.col("pos") == F.col("last"), F.lit(TURN_END)).otherwise(F.lit("")).alias("tail"),
        (F.col("role") == trained_role).alias("trained"),
        F.when(
            attached,
            F.struct(
                number.cast("bigint").alias("number"),
                kind.alias("type"),
                F.col("part.ref").alias("ref"),
                (F.coalesce("part.units", F.lit(1)) * F.element_at(known, kind)).cast("bigint").alias("tokens"),
            ),
        ).alias("attachment"),
    )
    by_number = W.partitionBy("conv").orderBy("n")
    whole = F.concat("head", "body", "tail")
    before = F.sum(F.length(whole)).over(by_number) - F.length(whole) + F.length("head")
    placed = pieces.select(
        "conv",
        F.struct(
            "n",
            whole.alias("piece"),
            "trained",
            before.cast("bigint").alias("start"),
            F.length("body").cast("bigint").alias("length"),
            "attachment",
        ).alias("p"),
    )
    gathered = placed.groupBy("conv").agg(F.array_sort(F.collect_list("p")).alias("p"))
    spans = F.transform(
        F.filter("p", lambda p: p["trained"]), lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"))
    )
    attachments = F.transform(
        F.filter("p", lambda p: p["attachment"].isNotNull()),
        lambda p: F.struct(
            p["attachment"]["number"].alias("number"),
            p["attachment"]["type"].alias("type"),
            p["attachment"]["ref"].alias("ref"),
            p["attachment"]["tokens"].alias("tokens"),
            p["start"].alias("start"),
        ),
    )
    return gathered.select(
        F.col("conv").alias(conv),
        F.array_join(F.col("p.piece"), "").alias("formatted"),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def parse_formatted(formatted: str) -> Column:
    """The turns of a formatted conversation, as (role, text); placeholders stay as they are."""
    turns = F.filter(F.split(F.col(formatted), TURN_END), lambda t: F.length(t) > 0)

    def read(t: Column) -> Column:
        at = F.locate(": ", t)
        role = F.substr(t, F.lit(len(TURN_START) + 1), at - len(TURN_START) - 1)
        return F.struct(
            unescape(role, ROLE_ESCAPES).alias("role"), unescape(F.substr(t, at + 2)).alias("text")
        )

    return F.transform(turns, read)


def trained_text(formatted: str, spans: str) -> Column:
    """All text under the loss mask, in order, unescaped."""
    cut = lambda s: unescape(F.substr(F.col(formatted), (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(F.col(spans), cut), "")
