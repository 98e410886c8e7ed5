import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.functions import chatml
from corpusloom.functions.text import globs_to_regex, python_text, split_once, str_strip
from corpusloom.operators import render
from corpusloom.operators.quality import (
    row_at,
    score_filter,
    score_rejects,
    score_value,
    slice_rows,
    take,
    take_batches,
)


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_strip_every_space(spark):
    chars = [chr(c) for c in [*range(1, 0xD800), *range(0xE000, 0x3100 + 0xE000)]]
    texts = [f"{c}a{c}b{c}{c}" for c in chars] + ["", " ", "\n\t", "　\x1c\t\x85a　b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    assert one(df, str_strip("t")) == [t.strip() for t in texts]


def test_split_and_none(spark):
    df = spark.createDataFrame([("a.b.c",), ("abc",), (None,)], "t string").coalesce(1)
    assert one(df, split_once("t", ".")) == [["a", "b.c"], ["abc"], None]
    assert one(df, python_text("t")) == ["a.b.c", "abc", "None"]
    odd = spark.createDataFrame([("x\\Ey\\Ez",)], "t string")
    assert one(odd, split_once("t", "\\E")) == [["x", "y\\Ez"]]


def test_globs():
    assert globs_to_regex(["*.parquet", "a.b"]) == ".*\\.parquet|a\\.b"


def test_scores(spark):
    texts = ["0.85", " 0.9 ", "0.849", "nan", "abc", None, "inf", "-1"]
    df = spark.createDataFrame([(t,) for t in texts], "score string")
    assert sorted(one(score_filter(df), "score")) == [" 0.9 ", "0.85", "inf"]
    assert set(one(score_rejects(df), "score")) == {"abc", None}
    with pytest.raises(PySparkException):
        score_rejects(df, strict=True).collect()
    numbers = spark.createDataFrame([(0.85,), (float("nan"),), (0.1,), (None,)], "score double")
    assert one(score_filter(numbers), "score") == [0.85]


def test_score_text_reads_like_python(spark):
    texts = ["1", "0.9", ".9", "9.", "1e3", "1E-2", "+0.9", "-.5e+1", "1_0", "1_0.0_1", "\u30000.9\n", "0.9\x1c", "inf", "-Infinity",
             "0.9f", "0.9d", "1__0", "_1", "1_", "0x1p3", "", " ", "1 2", ".", "e5", "one", "1e", "--1"]
    df = spark.createDataFrame([(t,) for t in texts], "score string").coalesce(1)

    def read(text):
        try:
            return float(text)
        except ValueError:
            return None

    assert one(df, score_value(df, "score")) == [read(t) for t in texts]


def test_positions(spark):
    df = spark.range(5000).repartition(6)
    assert sorted(r.id for r in take(df, 7, "id").collect()) == list(range(7))
    assert take(df, 2500, "id").count() == 2500
    assert take(df, 9000, "id").count() == 5000
    assert sorted(r.id for r in slice_rows(df, 10, 13, "id").collect()) == [10, 11, 12]
    assert slice_rows(df, 4990, None, "id").count() == 10
    assert slice_rows(df, 0, None, "id").count() == 5000
    assert slice_rows(df, 6000, None, "id").count() == slice_rows(df, 5, 5, "id").count() == 0
    assert take_batches(df, 100, 8, "id").count() == 102 * 8
    assert [r.id for r in row_at(df, 3, "id").collect()] == [3]
    assert [r.id for r in row_at(df, 4999, "id").collect()] == [4999]
    assert row_at(df, 5000, "id").count() == 0


PAIR = "<|im_start|>user\n{}<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n{}<|im_end|>\n"


def test_instruction_prompt_prints_none(spark):
    df = spark.createDataFrame([(1, None, " r ")], "k int, prompt string, response string")
    assert one(render.instruction_prompt(df, ["k"]), "text") == [
        "### Instruction:\nNone\n### Response:\n r "
    ]


def test_chat_forms(spark):
    df = spark.createDataFrame([(1, "\x85 p ", "　r\n")], "k int, prompt string, response string")
    assert one(render.chat_prompt_response(df, ["k"]), "text") == [PAIR.format("p", "r")]
    with_system = one(render.chat_prompt_response(df, ["k"], system="S"), "text")
    assert with_system == ["<|im_start|>system\nS<|im_end|>\n" + PAIR.format("p", "r")]
    df = spark.createDataFrame(
        [(1, " a ", "", "o")], "k int, instruction string, input string, output string"
    )
    assert one(render.chat_instruction_input(df, ["k"]), "text") == [PAIR.format("a\n", "o")]


def test_multi_turn_thinks_only_at_the_end(spark):
    df = spark.createDataFrame(
        [(1, [(" a ", "b"), ("c", " d")])],
        "k int, conversation array<struct<human: string, assistant: string>>",
    )
    first = "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert one(render.chat_multi_turn(df, ["k"]), "text") == [first + PAIR.format("c", "d")]
    plain = one(render.chat_multi_turn(df, ["k"], think_on_last=False), "text")[0]
    assert "think" not in plain


def test_first_exchange(spark):
    schema = "k int, conversations array<struct<value: string>>"
    df = spark.createDataFrame([(1, [(" a",), ("b",), ("c",)])], schema)
    assert one(render.chat_first_exchange(df, ["k"]), "text") == [PAIR.format(" a", "b")]
    short = spark.createDataFrame([(1, [("a",), ("b",)]), (2, [("a",)])], schema)
    with pytest.raises(PySparkException):
        render.chat_first_exchange(short, ["k"]).collect()
    lenient = render.chat_first_exchange(short, ["k"], strict=False)
    assert one(render.unrendered(lenient), "k") == [2]


def test_generation_prompt(spark):
    df = spark.createDataFrame([(1, "q")], "k int, prompt string")
    base = "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"
    assert one(render.generation_prompt(df, ["k"]), "text") == [base]
    assert one(render.generation_prompt(df, ["k"], thinking=False), "text") == [
        base + "<think>\n\n</think>\n\n"
    ]


def test_null_content_gives_null(spark):
    messages = F.array(chatml.message("user", F.lit("a")), chatml.message("user", F.col("t")))
    df = spark.createDataFrame([(None,), ("b",)], "t string").coalesce(1)
    got = one(df, chatml.render_messages(messages))
    assert got[0] is None and got[1].endswith("b<|im_end|>\n")
