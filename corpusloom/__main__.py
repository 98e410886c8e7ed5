"""Jobs for spark-submit: ``count`` tokens, build the ``pretrain`` mixture, build ``sft`` text or examples.

    python -m corpusloom count --path 'data/web/part-0[0-1]*.parquet' --field content \\
        --min-score 0.85
    python -m corpusloom pretrain --sources sources.json --out blocks --seq-len 1024
    python -m corpusloom sft --path data/chat --format jsonl --out rendered
    python -m corpusloom sft --path data/chat --out examples --max-length 1024 --tokenizer words

``sources.json`` lists the sources in order, each an object with ``name``, ``path`` and
optionally ``format``, ``text``, ``score`` and ``instruct``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.chatml import TURN_START
from corpusloom.functions.tokenizers import BYTES, WORDS, bpe_from_json
from corpusloom.operators.quality import score_filter
from corpusloom.operators.render import chat_prompt_response
from corpusloom.operators.tokens import token_report, total_tokens
from corpusloom.plans.finetune import sft_examples
from corpusloom.plans.pretrain import CorpusSource, pretrain_mixture
from corpusloom.session import build_session
from corpusloom.sources.scan import INSTRUCT, ROW_KEY, scan_jsonl, scan_parquet
from corpusloom.sources.store import write_blocks


def tokenizer_named(name: str):
    """``words``, ``bytes`` or the path of a tokenizer.json file."""
    if name in ("words", "bytes"):
        return WORDS if name == "words" else BYTES
    with open(name, encoding="utf-8") as f:
        return bpe_from_json(f.read())


def scan(spark: SparkSession, path: str, fmt: str, columns: list[str], row_key: bool) -> DataFrame:
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    if fmt == "jsonl":
        return scan_jsonl(spark, path, schema, row_key)
    df = scan_parquet(spark, path, row_key=row_key)
    return df.select(*columns, *([ROW_KEY] if row_key else []))


def count(spark: SparkSession, args) -> None:
    fields = [args.field, *([args.field1] if args.field1 else [])]
    columns = fields + ([args.score_column] if args.min_score is not None else [])
    df = scan(spark, args.path, args.format, columns, row_key=False)
    if args.min_score is not None:
        df = score_filter(df, args.score_column, args.min_score)
    totals = total_tokens(df, args.field, args.field1, tokenizer_named(args.tokenizer))
    row = token_report(totals).first()
    print(f"total tokens: {row['total_tokens']} ({row['billions']})")


def corpus_source(spark: SparkSession, spec: dict) -> CorpusSource:
    fmt, instruct = spec.get("format", "parquet"), spec.get("instruct", False)
    text, score = spec.get("text", "content"), spec.get("score")
    columns = ["prompt", "response"] if instruct else [text, *([score] if score else [])]
    df = scan(spark, spec["path"], fmt, columns, row_key=True)
    return CorpusSource(df, ROW_KEY, text, score, instruct)


def pretrain(spark: SparkSession, args) -> None:
    with open(args.sources, encoding="utf-8") as f:
        sources = {spec["name"]: corpus_source(spark, spec) for spec in json.load(f)}
    blocks = pretrain_mixture(
        sources,
        args.seq_len,
        args.batch_rows,
        args.min_score,
        args.shards,
        tokenizer_named(args.tokenizer),
    )
    write_blocks(blocks, args.out)


def sft(spark: SparkSession, args) -> None:
    columns = [f.strip() for f in INSTRUCT.replace(" STRING", "").split(",")]
    df = scan(spark, args.path, args.format, columns, row_key=True)
    rows = chat_prompt_response(df, [ROW_KEY], system=args.system)
    if args.max_length is not None:
        tokenizer = tokenizer_named(args.tokenizer)
        marks = [tokenizer.tokens(F.lit(f"{TURN_START}{role}")) for role in ("user", "assistant")]
        instruction, response = spark.range(1).select(*marks).first()
        rows = sft_examples(rows, [ROW_KEY], args.max_length, instruction, response, tokenizer)
    rows.write.parquet(args.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom")
    jobs = p.add_subparsers(dest="job", required=True)

    c = jobs.add_parser("count")
    c.add_argument("--path", required=True)
    c.add_argument("--format", choices=["parquet", "jsonl"], default="parquet")
    c.add_argument("--field", default="text")
    c.add_argument("--field1")
    c.add_argument("--min-score", type=float)
    c.add_argument("--score-column", default="score")
    c.add_argument("--tokenizer", default="words")
    c.set_defaults(run=count)

    b = jobs.add_parser("pretrain")
    b.add_argument("--sources", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--seq-len", type=int, default=1024)
    b.add_argument("--batch-rows", type=int, default=1024)
    b.add_argument("--min-score", type=float, default=0.85)
    b.add_argument("--shards", type=int, default=1)
    b.add_argument("--tokenizer", default="words")
    b.set_defaults(run=pretrain)

    s = jobs.add_parser("sft")
    s.add_argument("--path", required=True)
    s.add_argument("--format", choices=["parquet", "jsonl"], default="jsonl")
    s.add_argument("--out", required=True)
    s.add_argument("--system")
    s.add_argument("--max-length", type=int, help="write token ids, cut to this length, and labels instead of text")
    s.add_argument("--tokenizer", default="words")
    s.set_defaults(run=sft)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(f"corpusloom {args.job}"), args)


if __name__ == "__main__":
    main()
