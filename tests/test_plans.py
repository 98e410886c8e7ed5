"""The physical plans: what moves, what is pushed down, what stays out of Python."""

import os
import re
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from corpusloom.operators import labels, packing, tokens
from corpusloom.operators.dialogue import render_conversation
from corpusloom.operators.quality import score_filter, take
from corpusloom.queries import all_queries
from corpusloom.queries import tables as t

QUERIES = all_queries()[0]
PYTHON = {
    "encode_ids", "encode_ids_large", "decode_ids", "route_topk", "route_load",
    "map_batches", "map_batches_ordered", "map_batch_chunks", "map_rows", "filter_rows", "position_ids", "pack_stream",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in PYTHON])
def test_no_python_workers(name, spark, sf):
    text = plan(QUERIES[name](spark, sf))
    assert not re.search(r"EvalPython|InPandas|InArrow|CartesianProduct|NestedLoop", text)


def test_filter_and_columns_reach_the_scan(spark, sf):
    labels = t.table(spark, sf, "labels", t.LABELS)
    text = plan(score_filter(labels, "quality", 1).select("doc_id"))
    assert "GreaterThanOrEqual(quality,1)" in text and "toxic" not in text
    assert "LessThan(doc_id,100)" in plan(take(t.documents(spark, sf), 100, "doc_id"))
    counted = plan(tokens.total_tokens(t.documents(spark, sf), "text"))
    assert re.search(r"ReadSchema: struct<text:string>", counted)


def moved(text, how):
    """What each exchange of a plan moves: the columns of the node below it, as printed."""
    lines = text.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if f"Exchange {how}" in line]


def test_packing_moves_rows_once(spark, sf):
    """The text moves once by segment, the places of its keys beside it; the join adds no exchange."""
    docs = t.documents(spark, sf)
    text = plan(packing.pack_text(docs, "text", "doc_id", 128, 16))
    # Up to 100,000 keys are one range, and one task; more are dealt out by ranges. Texts never go there.
    singles = [line for line in moved(text, "SinglePartition") if "text" in line]
    assert not singles and len([line for line in moved(text, "hashpartitioning") if "text" in line]) == 1
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", text)) == {"segment"}
    # Tokens are made above the join: only the text is shuffled.
    join = re.search(r"(SortMerge|BroadcastHash)Join", text).start()
    assert text.index("regexp_extract_all") < join < text.index("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["pack", "pack_columns", "pack_text", "sequence_offsets", "pretrain_mixture"])
def test_no_list_goes_through_a_window(name, spark, sf):
    docs = tokens.tokenize(t.documents(spark, sf), "text", ["doc_id"])
    made = {
        "pack": lambda: packing.pack(docs, "doc_id", 64, 16),
        "pack_columns": lambda: packing.pack(docs, "doc_id", 64, 16, ["input_ids", "attention_mask"]),
        "pack_text": lambda: packing.pack_text(t.documents(spark, sf), "text", "doc_id", 64, 16),
        "sequence_offsets": lambda: labels.sequence_offsets(docs, "doc_id", 16),
        "pretrain_mixture": lambda: QUERIES["pretrain_mixture"](spark, sf),
    }[name]()
    found = made._jdf.queryExecution().optimizedPlan()
    windows = [line for line in found.toString().splitlines() if re.search(r"\bWindow \[", line)]
    assert windows and not any(re.search(r"input_ids|attention_mask|text|content|collect_list", line) for line in windows)
    for node in walk(found):
        if node.nodeName() == "Window":
            assert "ArrayType" not in node.child().schema().toString()


def walk(node):
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from walk(children.apply(i))


def test_rendering_moves_turns_once_and_chunks_once(spark, sf):
    """Facts and the chunks that occur are narrow (three exchanges and a join's two); turns with
    their text move once by chunk, and the chunks' texts once more to become one row."""
    text = plan(render_conversation(t.conversations(spark, sf)))
    assert exchanges(text) <= 7
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "_part" not in line and "chunk" in line]
    assert len(wide) <= 2


def test_tokens_are_made_once(spark, sf):
    words = tokens.tokenize(t.documents(spark, sf), "text", ["doc_id"])
    assert plan(tokens.token_frequencies(words)).count("regexp_extract_all") == 1


def test_joined_encoding_reads_documents_once(spark, sf, monkeypatch):
    """What the lookup finds and misses is written; the plan reads that, not the documents again."""
    monkeypatch.setattr(tokens, "BROADCAST_ROWS", 50)
    words = tokens.tokenize(t.documents(spark, sf), "text", ["doc_id"])
    encoded = tokens.encode_ids(words, tokens.vocab(words), "doc_id", in_place_rows=0)
    text = plan(encoded)
    assert "documents.parquet" not in text and "regexp_extract_all" not in text
    assert text.count("ArrowEvalPython") <= 2


def test_workers_need_no_package(sf, tmp_path):
    """Python workers run the library's functions without having it on their path."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from corpusloom.operators import tokens
from corpusloom.session import build_session
tokens.IN_PLACE_ROWS = tokens.BROADCAST_ROWS = 1000
spark = build_session(master="local[4]", conf={{"spark.ui.enabled": "false"}})
for name in {sorted(PYTHON)!r}:
    assert entry.queries()[name](spark, {sf!r}).count() > 0, name
print("all ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "all ran" in done.stdout, done.stderr[-2000:]
