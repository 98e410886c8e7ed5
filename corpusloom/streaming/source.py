"""The corpus scans as streams.

Row-wise operators (filter, render, tokenize, count) work on a stream unchanged. Packing goes by
position and keeps state: see :mod:`corpusloom.streaming.packing`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.tokenizers import WORDS
from corpusloom.sources.store import exists, is_file


def stream_source(
    spark: SparkSession,
    root: str,
    fmt: str,
    schema: str | T.StructType,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Files below ``root`` as a stream; new files arrive as new rows. ``root`` may be one file, as a table may be one
    or a folder of them. ``glob`` is matched with the names of files, not of folders."""
    if is_file(spark, root):
        # A stream takes folders or globs, so the file is named by a glob of its own.
        root = f"{root[:-1]}[{root[-1]}]"
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(root)


def drain_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available now to ``path``, exactly once, then stop."""
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )


def running_totals(stream: DataFrame, text: str, by: list[str], tokenizer=WORDS) -> DataFrame:
    """Rows and tokens per source so far. The state is one row per source."""
    return stream.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.sum(tokenizer.count(text).cast("bigint")).alias("total_tokens"),
    )


def drain_totals(totals: DataFrame, path: str, checkpoint: str) -> None:
    """Write the running totals of each micro-batch, complete each time, as ``epoch=`` folders below ``path``.

    An epoch is one file, which appears whole, so a reader of :func:`read_totals` sees some finished epoch at any time. A
    repeated micro-batch writes its own epoch again, with the same rows.
    """

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch}")

    (
        totals.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_totals(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The totals of the last epoch that is there. Totals never lose a row, so every epoch but an empty
    stream's has some. A stream that no file has reached has no epoch, and no totals."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    epochs = spark.read.schema(T.StructType([*schema, T.StructField("epoch", T.LongType())])).parquet(path)
    last = epochs.agg(F.max("epoch")).first()[0]
    return epochs.where(F.col("epoch").eqNullSafe(last)).drop("epoch")
