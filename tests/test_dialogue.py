"""Dialogue operators against a plain reading of one dialogue at a time."""

import random

import pytest

from corpusloom.functions.tokenizers import BYTES, WORDS
from corpusloom.operators import dialogue as d

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def make(seed, n=120):
    rng = random.Random(seed)
    dialogues = {}
    for c in range(n):
        roles = ["system"] * (rng.random() < 0.3)
        roles += [("user", "assistant")[i % 2] for i in range(rng.randrange(0, 14))]
        if rng.random() < 0.25 and roles:
            roles[rng.randrange(len(roles))] = rng.choice(["user", "assistant", "system"])
        dialogues[c] = [
            (r, "" if r == "system" and rng.random() < 0.3 else " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(1, 9))) + " ")
            for r in roles
        ]
    return {c: v for c, v in dialogues.items() if v}


def table(spark, dialogues):
    rows = [(c, i, r, t) for c, ms in dialogues.items() for i, (r, t) in enumerate(ms)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


#: Written-out dialogues: turns, whether they are valid, what they consist of.
WRITTEN = {
    1: ([("user", "q")], True, {("query", 0): ("q", None)}),
    2: ([("user", "a"), ("assistant", "b"), ("user", "q")], True, {("history", 0): ("a", "b"), ("query", 1): ("q", None)}),
    3: ([("system", "s"), ("user", "q")], True, {("system", None): ("s", None), ("query", 0): ("q", None)}),
    4: ([("user", "a"), ("assistant", "b")], False, {}),
    5: ([("system", "s")], False, {}),
    6: ([("user", "a"), ("user", "b"), ("user", "q")], False, {}),
    7: ([("assistant", "a"), ("user", "b"), ("user", "q")], False, {}),
    8: ([("user", "a"), ("assistant", "b"), ("system", "s"), ("user", "q")], False, {}),
}


@pytest.mark.parametrize("chunk", [1024, 2])
def test_valid_and_parse(spark, monkeypatch, chunk):
    monkeypatch.setattr(d, "CHUNK_TURNS", chunk)
    turns = table(spark, {c: w[0] for c, w in WRITTEN.items()})
    assert {r.conv_id: r.valid for r in d.dialogue_valid(turns).collect()} == {c: w[1] for c, w in WRITTEN.items()}
    rows = {(r.conv_id, r.kind, r.exchange): (r.user, r.assistant) for r in d.parse_dialogue(turns).collect()}
    assert rows == {(c, *at): texts for c, w in WRITTEN.items() for at, texts in w[2].items()}


@pytest.mark.parametrize(
    "max_input, text",
    [
        # The system's mark and text are 2 words, the query's 2, the opened answer 1, an exchange 4.
        (9, "<|system|>\ns\n<|user|>\nq\n<|assistant|>\n"),
        (10, "<|system|>\ns\n<|user|>\nc\n<|assistant|>\nd\n<|user|>\nq\n<|assistant|>\n"),
        (13, "<|system|>\ns\n<|user|>\nc\n<|assistant|>\nd\n<|user|>\nq\n<|assistant|>\n"),
        (14, "<|system|>\ns\n<|user|>\na\n<|assistant|>\nb\n<|user|>\nc\n<|assistant|>\nd\n<|user|>\nq\n<|assistant|>\n"),
    ],
)
def test_context(spark, max_input, text):
    ms = [("system", "s"), ("user", "a"), ("assistant", "b"), ("user", " c "), ("assistant", "d"), ("user", "q")]
    assert d.build_context(table(spark, {1: ms}), max_input).first()["context"] == text


@pytest.mark.parametrize("tokenizer", [WORDS, BYTES])
def test_kept_history_is_the_newest_run_that_fits(spark, tokenizer):
    turns = table(spark, make(8, 60)).cache()
    valid = {r.conv_id for r in d.dialogue_valid(turns).where("valid").collect()}
    everything = {(r.conv_id, r.exchange): r.num_tokens for r in d.history_budget(turns, 10**6, tokenizer=tokenizer).collect()}
    last = {c: max(x for v, x in everything if v == c) for c, _ in everything}
    before: dict = {}
    for max_input in (20, 45, 80, 400):
        rows = d.history_budget(turns, max_input, tokenizer=tokenizer).collect()
        kept = {c: sorted(r.exchange for r in rows if r.conv_id == c) for c in valid}
        budget = {r.conv_id: r.budget for r in rows}
        for c, run in kept.items():
            assert set(before.get(c, [])) <= set(run)
            if run:
                assert run == list(range(run[0], last[c] + 1))
                used = sum(everything[c, x] for x in run)
                assert used < budget[c]
                assert run[0] == 0 or used + everything[c, run[0] - 1] >= budget[c]
        before = kept


def test_exchanges_that_cost_nothing_are_all_kept(spark):
    ms = [(("user", "assistant")[i % 2], "x") for i in range(15)]
    han = type(WORDS)("[\u4e00-\u9fff]")
    assert d.history_budget(table(spark, {1: ms}), 3, system="", tokenizer=han).count() == 7


def test_exchange_equal_to_budget_is_left_out(spark):
    # system 6, query 2, opened answer 1, one exchange of 4 words
    ms = {1: [("user", "a"), ("assistant", "b"), ("user", "q")]}
    assert d.history_budget(table(spark, ms), 6 + 2 + 1 + 4).count() == 0
    assert d.history_budget(table(spark, ms), 6 + 2 + 1 + 5).count() == 1


def test_a_long_conversation_is_one_row(spark):
    ms = [("system", "S"), *((("user", "assistant")[i % 2], f"t{i}") for i in range(1024))]
    rows = {r.conv_id: r.text for r in d.render_conversation(table(spark, {7: ms, 8: ms[:3]})).collect()}
    assert sorted(rows) == [7, 8]
    assert rows[7].startswith("<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nt0<|im_end|>\n")
    assert rows[7].endswith("<|im_start|>assistant\n<think>\n\n</think>\n\nt1023<|im_end|>\n")
    assert rows[7].count("<|im_start|>") == 1025 and rows[7].count("<think>") == 1
    assert rows[7].index("t9<") < rows[7].index("t10<") < rows[7].index("t1000<")


def test_conversations_without_an_id_are_rendered(spark):
    turns = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b")], SCHEMA)
    rows = d.render_conversation(turns, think_on_last=False).collect()
    assert [(r.conv_id, r.text.count("<|im_start|>")) for r in rows] == [(None, 2)]


def test_exchanges_and_rewards(spark):
    ms = {1: [("user", "ab"), ("assistant", "中国\U0001f600"), ("user", "x")]}
    rows = d.length_reward(d.exchanges(table(spark, ms))).collect()
    assert [(r.turn, r.prompt, r.reward) for r in rows] == [(0, "ab", 3)]


@pytest.mark.parametrize("chunk", [512, 3, 1])
def test_totals_over_chunks(spark, monkeypatch, chunk):
    """Whatever the chunks, the totals are those of a walk from the newest exchange."""
    monkeypatch.setattr(d, "CHUNK_EXCHANGES", chunk)
    dialogues = make(21, 50)
    dialogues[1000] = [(("user", "assistant")[i % 2], f"{'w ' * (i % 5)}x") for i in range(301)]
    turns = table(spark, dialogues)
    valid = {r.conv_id for r in d.dialogue_valid(turns).where("valid").collect()}
    assert 1000 in valid
    for max_input in (40, 700):
        rows = {(r.conv_id, r.exchange): (r.num_tokens, r.cum_tokens, r.budget) for r in d.history_budget(turns, max_input).collect()}
        expected = {}
        for c in valid:
            ms = dialogues[c]
            own = ms[0][0] == "system"
            told = ms[0][1] if own and ms[0][1] != "" else d.DEFAULT_SYSTEM
            budget = max_input - (1 + len(told.split())) - (1 + len(ms[-1][1].split())) - 1
            rest, total = ms[own:-1], 0
            for x in reversed(range(len(rest) // 2)):
                n = sum(1 + len(text.split()) for _, text in rest[2 * x : 2 * x + 2])
                total += n
                if total >= budget:
                    break
                expected[c, x] = (n, total, budget)
        assert rows == expected
        texts = {r.conv_id: r["context"] for r in d.build_context(turns, max_input).collect()}
        ids = {r.conv_id: (r.input_ids, r.num_tokens) for r in d.build_context_ids(turns, max_input).collect()}
        assert set(texts) == set(ids) == valid
        assert all(ids[c] == (texts[c].split(), len(texts[c].split())) for c in valid)


def test_free_marks_keep_a_long_history(spark, monkeypatch):
    """Exchanges that cost nothing are all kept, chunk after chunk."""
    monkeypatch.setattr(d, "CHUNK_EXCHANGES", 10)
    ms = [(("user", "assistant")[i % 2], "x") for i in range(2001)]
    han = type(WORDS)("[\u4e00-\u9fff]")
    assert d.history_budget(table(spark, {1: ms, 2: ms[:5]}), 3, system="", tokenizer=han).count() == 1002


def test_windows_over_turns_are_by_chunk(spark):
    plan = d.history_budget(table(spark, make(3, 5)), 50)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("part" in line or "_history" in line or "_other" in line for line in windows)
    assert not any("piece" in line.split("Window [")[1].split("]")[0] for line in windows)


def test_context_ids_are_made_message_by_message(spark):
    ms = [("user", " é "), ("assistant", "b"), ("user", "q")]
    row = d.build_context_ids(table(spark, {1: ms}), 500, system="S", tokenizer=BYTES).first()
    text = d.build_context(table(spark, {1: ms}), 500, system="S", tokenizer=BYTES).first()["context"]
    assert bytes(row.input_ids).decode() == text and row.num_tokens == len(text.encode())


@pytest.mark.parametrize("keep_end", [True, False])
@pytest.mark.parametrize("most, most_prompt", [(5, None), (4, 2), (1, 1), (100, 3)])
def test_preference_pairs_are_capped_as_a_whole(spark, keep_end, most, most_prompt):
    rows = [(1, "a b c d", "e f", "g"), (2, "", "h i j k l m n", ""), (3, "a", None, "b"), (4, "p q", "r", "s t u v w x")]
    df = spark.createDataFrame(rows, "k int, prompt string, chosen string, rejected string")

    def cut(xs, n):
        return xs if n is None or len(xs) <= n else xs[-n:] if keep_end else xs[:n]

    for r in d.preference_pairs(df, ["k"], most, most_prompt, keep_end).collect():
        prompt, *answers = [None if x is None else x.split() for x in rows[r.k - 1][1:]]
        prompt = cut(prompt, most_prompt)
        for name, answer in zip(("chosen", "rejected"), answers):
            if answer is None:
                assert r[f"{name}_ids"] is None and r[f"{name}_mask"] is None
            else:
                assert r[f"{name}_ids"] == cut(prompt + answer, most)
                assert r[f"{name}_mask"] == cut([0] * len(prompt) + [1] * len(answer), most)
