import json

from corpusloom.__main__ import main


def test_jobs(spark, tmp_path, capsys, sf):
    pages = [{"content": "a b c", "score": "0.9"}, {"content": "d", "score": "0.1"}, {"content": "e", "score": "1"}]
    spark.createDataFrame(pages, "content string, score string").coalesce(1).write.parquet(f"{tmp_path}/web")
    with open(tmp_path / "chat.jsonl", "w") as f:
        for i in range(3):
            f.write(json.dumps({"prompt": f" p{i} ", "response": "r"}) + "\n")

    main(["count", "--path", f"{tmp_path}/web", "--field", "content", "--min-score", "0.85"])
    main(["count", "--path", str(tmp_path), "--format", "jsonl", "--field", "prompt", "--field1", "response"])
    out = capsys.readouterr().out
    assert "total tokens: 4 " in out and "total tokens: 6 " in out

    specs = [
        {"name": "web", "path": f"{tmp_path}/web", "score": "score"},
        {"name": "chat", "path": str(tmp_path), "format": "jsonl", "instruct": True},
    ]
    (tmp_path / "sources.json").write_text(json.dumps(specs))
    main(["pretrain", "--sources", f"{tmp_path}/sources.json", "--out", f"{tmp_path}/blocks", "--seq-len", "2"])
    rows = spark.read.parquet(f"{tmp_path}/blocks").where("source = 'web'").orderBy("block_id").collect()
    assert [r.input_ids for r in rows] == [["a", "b"], ["c", "e"]]
    assert spark.read.parquet(f"{tmp_path}/blocks").where("source = 'chat'").count() == 9

    main(["sft", "--path", str(tmp_path), "--out", f"{tmp_path}/rendered"])
    texts = [r.text for r in spark.read.parquet(f"{tmp_path}/rendered").orderBy("row_key").collect()]
    assert len(texts) == 3 and texts[0].startswith("<|im_start|>user\np0<|im_end|>")


def test_sft_examples_from_the_shell(spark, tmp_path):
    with open(tmp_path / "chat.jsonl", "w") as f:
        for i in range(3):
            f.write(json.dumps({"prompt": f"p{i} q", "response": "r s t"}) + "\n")
    for tokenizer, ignore in (("words", "-100"), ("bytes", -100)):
        out = f"{tmp_path}/{tokenizer}"
        main(["sft", "--path", str(tmp_path), "--out", out, "--max-length", "400", "--tokenizer", tokenizer])
        rows = spark.read.parquet(out).orderBy("row_key").collect()
        assert len(rows) == 3
        for r in rows:
            assert len(r.input_ids) == len(r.labels) == len(r.attention_mask)
            seen = [x for x in r.labels if x != ignore]
            said = " ".join(seen) if tokenizer == "words" else bytes(seen).decode()
            assert "r s t<|im_end|>" in said and "q" not in said
    main(["sft", "--path", str(tmp_path), "--out", f"{tmp_path}/short", "--max-length", "2"])
    assert {len(r.input_ids) for r in spark.read.parquet(f"{tmp_path}/short").collect()} == {2}
