"""A corpus pipeline of five operators: quality, near duplicates, repeats, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
that ``docs`` has. :func:`run` writes each result as Parquet in the shared folder and reads it as
the next stage's ``docs``.

Every stage works on all rows that it is given. Empty tables stay empty. What null texts, null and
repeated ids become is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.jaccard import near_duplicates
from corpusloom.llm.mixing import mix_documents
from corpusloom.llm.packing import Limits, pack_documents, with_crc32
from corpusloom.llm.quality import fit_quality_model, score_quality
from corpusloom.llm.queries import END_ID, graded, tokenizer_file
from corpusloom.llm.repeats import remove_repeats
from corpusloom.queries.tables import LABELS, table
from corpusloom.sources.store import drop_staged, stage

#: No SQL expresses a fitted classifier; the stages and run() are tested row by row against plain loops instead.
ORACLE_SQL = None


def _columns(df: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in df.columns]


def grade_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what is more likely than not of the top grade: neither poor nor toxic. Texts without words go."""
    ratings = graded(table(spark, sf_dir, "labels", LABELS))
    model = fit_quality_model(docs, ratings, "doc_id", "text", "grade", 3)
    held = docs.select(F.struct(*_columns(docs)).alias("row"), F.col("text"))
    return score_quality(held, "text", model).where("quality.keep").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: the one with the smallest id. Rows without an id come after
    all others, equal ids go by a hash of the text. Rows are judged each by its own text, whatever their
    ids: rows that share an id are dropped only as copies themselves. Rows that repeat an id (or have none)
    and the text become one; texts without words are in no group."""
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        docs = docs.dropDuplicates(["doc_id", "text"])
    row_key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    found = near_duplicates(docs.select(row_key.alias("row_key"), "text"), "row_key", "text")
    gone = found.where("class_id <> row_key").select(
        F.col("row_key.id").alias("gone_id"), F.col("row_key.h").alias("gone_h")
    )
    gone = stage(gone, "near-copies")
    same = F.xxhash64("text") == F.col("gone_h")
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & same, "left_anti")


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut what repeats a document with a smaller id; a text that loses nothing stays as it is, and
    ``n_chars`` follows the text. Null texts stay null; a text may become empty."""
    cut = remove_repeats(docs, "doc_id", "text", carry=tuple(docs.columns))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        shorter = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType))
        new["n_chars"] = shorter.otherwise(F.col("rest.n_chars"))
    return cut.select(*[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mixture takes them; a null source is one of its own."""
    return mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences; null texts are empty, repeated rows are packed each."""
    pieces = pack_documents(docs, "doc_id", "text", tokenizer_file(), END_ID, Limits())
    return with_crc32(pieces).withColumnRenamed("example_tokens", "doc_tokens")


STAGES = [
    ("quality", grade_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", remove_repeated_passages),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_staged(before)
        before = docs
    return docs
