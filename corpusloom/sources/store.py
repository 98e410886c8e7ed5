"""Written tables: reuse of finished work, block sink, staging of shared inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.session import shared_path


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_file(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(target) and files.getFileStatus(target).isFile()


def _only_unfinished(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds nothing but what a write that did not finish leaves."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return all(f.getPath().getName() == "_temporary" for f in found)


def materialize_or_reuse(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """Read ``path`` if a finished write is there, else build, write and read it.

    Only the ``_SUCCESS`` mark counts as finished, so a folder left by a failed job is
    rebuilt and ``build`` is not even called for a finished one. A folder without the mark that
    holds anything else than an unfinished write's is not ours, and is left alone with an error.
    """
    if not exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        mode = "errorifexists"
        if exists(spark, path):
            if not _only_unfinished(spark, path):
                raise FileExistsError(f"{path} holds files that no unfinished write left there")
            mode = "overwrite"
        build().write.mode(mode).parquet(path)
    return spark.read.parquet(path)


def write_blocks(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Packed blocks as Parquet, one folder per source.

    No repartition by source: a source may hold most of the rows, and every task can
    write its own file in each folder.
    """
    df.write.mode(mode).partitionBy("source").parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For results that several later steps consume: it cuts the lineage, survives lost
    executors, and gives every consumer the same rows. :func:`drop_staged` takes the table away.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    read = spark.read.parquet(path)
    read.staged_path = path
    return read


def drop_staged(*tables: DataFrame) -> None:
    """Delete tables that :func:`stage` returned, once nothing unwritten reads them any more."""
    for table in tables:
        spark = table.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(table.staged_path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
