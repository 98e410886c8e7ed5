"""The slots for user functions."""

from __future__ import annotations

from corpusloom.operators.tokens import tokenize
from corpusloom.operators.udf import filter_rows, map_batch_chunks, map_batches, map_rows
from corpusloom.queries import Registry
from corpusloom.queries import tables as t

R = Registry({}, {})


@R.add(
    "map_batches",
    "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents",
)
def _(spark, sf):
    def lines(batch):
        pairs = [
            (key, line) for key, text in zip(batch["doc_id"], batch["text"]) for line in text.split("\n")
        ]
        return {"doc_id": [p[0] for p in pairs], "line": [p[1] for p in pairs]}

    return map_batches(t.documents(spark, sf), lines, "doc_id BIGINT, line STRING", ["doc_id", "text"])


_NUMBERED = f"""r AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS rn, {t.words_sql("text")} AS ids FROM documents)"""


@R.add(
    "map_batches_ordered",
    f"WITH {_NUMBERED}, {t.pack_sql('r', 128, 'rn // 100')} SELECT batch_id, block_id, input_ids FROM packed",
)
def _(spark, sf):
    """Batches of 100 documents in order, packed by a user function."""

    def blocks(batch):
        # The token at place p of its batch belongs to block p // 128, which counts if it is full or the only one.
        found = {}
        for p, token in enumerate(token for ids in batch["input_ids"] for token in ids):
            found.setdefault(p // 128, []).append(token)
        kept = {n: block for n, block in found.items() if len(block) == 128 or len(found) == 1}
        return {
            "batch_id": [batch["batch_id"][0]] * len(kept),
            "block_id": list(kept),
            "input_ids": [" ".join(block) for block in kept.values()],
        }

    ids = tokenize(t.documents(spark, sf), "text", ["doc_id"])
    schema = "batch_id BIGINT, block_id BIGINT, input_ids STRING"
    return map_batches(ids, blocks, schema, ["input_ids"], order="doc_id", batch_rows=100)


@R.add(
    "map_batch_chunks",
    """WITH r AS (SELECT text, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents)
SELECT CAST(rn // 400 AS BIGINT) AS batch_id, count(*) AS num_rows, CAST(sum(length(text)) AS BIGINT) AS chars,
  sha256(string_agg(text, chr(10) ORDER BY rn)) AS digest FROM r GROUP BY 1""",
)
def _(spark, sf):
    """A digest of batches of 400 documents in order, which are never in memory as a whole."""

    def digests(chunks):
        import hashlib

        digest, rows, chars = hashlib.sha256(), 0, 0
        for chunk in chunks:
            for text in chunk["text"]:
                digest.update(("\n" * (rows > 0) + text).encode())
                rows, chars = rows + 1, chars + len(text)
        yield {"batch_id": [chunk["batch_id"][0]], "num_rows": [rows], "chars": [chars], "digest": [digest.hexdigest()]}

    schema = "batch_id BIGINT, num_rows BIGINT, chars BIGINT, digest STRING"
    return map_batch_chunks(t.documents(spark, sf), digests, schema, "doc_id", 400, ["text"])


@R.add("map_rows", "SELECT doc_id, length(text) - length(lang) AS chars FROM documents")
def _(spark, sf):
    docs = map_rows(
        t.documents(spark, sf), lambda text, lang: len(text) - len(lang), ["text", "lang"], "chars", "bigint"
    )
    return docs.select("doc_id", "chars")


@R.add(
    "filter_rows",
    "SELECT doc_id, lang FROM documents WHERE length(text) - length(replace(text, chr(10), '')) >= 2",
)
def _(spark, sf):
    kept = filter_rows(t.documents(spark, sf), lambda text: text.count("\n") >= 2, ["text"])
    return kept.select("doc_id", "lang")
