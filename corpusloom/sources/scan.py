"""File and named-table scans."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sources.store import stage

# Column layouts of the corpora this library prepares.
WEB_CORPUS = "content STRING, score STRING"
WIKI = "text STRING"
INSTRUCT = "prompt STRING, response STRING"
INPUT_TARGET = "input STRING, target STRING"
SHAREGPT = "conversations ARRAY<STRUCT<value: STRING>>"
MULTI_TURN = "conversation ARRAY<STRUCT<human: STRING, assistant: STRING>>"
ALPACA = "instruction STRING, input STRING, output STRING"
MESSAGES = "messages ARRAY<STRUCT<role: STRING, content: STRING>>"
PREFERENCE = "prompt STRING, chosen STRING, rejected STRING"

ROW_KEY = "row_key"
#: Splits whose row counts are broadcast, about 100 bytes each; those of more are joined by shuffle.
BROADCAST_SPLITS = 50_000


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail at plan time, with the columns there are, rather than in a task."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the source has {df.columns}")
    return df


def with_row_key(df: DataFrame, fmt: str) -> DataFrame:
    """Add ``row_key``, a string that sorts rows as files by name, then rows in the file.

    This is the row order packing needs when the data has no id. Parquet knows a row's
    index; rows of text formats are numbered by :func:`with_line_numbers`.
    """
    if fmt == "parquet":
        number, keyed = F.col("_metadata.row_index"), df
    else:
        keyed = with_line_numbers(df, "_line")
        number = F.col("_line")
    path = F.col("_metadata.file_path") if fmt == "parquet" else F.col("_line_file")
    key = F.concat_ws(":", path, F.lpad(number.cast("string"), 19, "0")).alias(ROW_KEY)
    return keyed.select(*[F.col(f"`{c}`") for c in df.columns], key)


def with_line_numbers(df: DataFrame, name: str) -> DataFrame:
    """Rows of a text scan with their file (``<name>_file``) and their 0-based number in it (``<name>``), which are the
    same however the file is cut into splits.

    A split is read by one task from its start to its end, so a row's place in the split is its place in the task less
    that of the split's first row. One job counts the rows of every split; what lies before a split in its file is a
    running sum over these counts, a table with a row for each split. ``df`` is the scan itself: filter afterwards. If
    the session's split options change between this call and the reading of its result, the splits are no longer those
    that were counted, and reading fails.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    tagged = df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("_metadata.file_path").alias(f"{name}_file"),
        F.col("_metadata.file_block_start").alias(f"{name}_split"),
        F.spark_partition_id().alias(f"{name}_task"),
        in_task.alias(f"{name}_place"),
    )
    split = [f"{name}_{c}" for c in ("file", "split", "task")]
    counted = tagged.groupBy(*split).agg(F.count(F.lit(1)).alias("n"), F.min(f"{name}_place").alias("first"))
    counted = stage(counted, "split-rows")
    earlier = W.partitionBy(split[0]).orderBy(split[1]).rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    index = counted.select(*split, before.alias(f"{name}_offset"))
    if counted.count() <= BROADCAST_SPLITS:
        index = F.broadcast(index)
    known = F.col(f"{name}_offset") + F.col(f"{name}_place")
    number = F.coalesce(known, F.raise_error(F.lit("the files are split otherwise than when their rows were counted")).cast("bigint"))
    return tagged.join(index, split, "left").select(
        *[F.col(f"`{c}`") for c in df.columns], split[0], number.alias(name)
    )


def scan_parquet(
    spark: SparkSession,
    paths: str | list[str],
    schema: str | T.StructType | None = None,
    row_key: bool = False,
) -> DataFrame:
    """Parquet files matching a glob; ``*`` and character classes such as ``[0-1]`` work."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    paths = [paths] if isinstance(paths, str) else paths
    df = reader.parquet(*paths)
    return with_row_key(df, "parquet") if row_key else df


def _json_reader(spark: SparkSession, schema: str | T.StructType, mode: str, row_key: bool):
    if row_key and mode.upper() == "DROPMALFORMED":
        # Which lines are dropped depends on the columns read, so places would shift.
        raise ValueError("row keys need mode FAILFAST or PERMISSIVE")
    return spark.read.schema(schema).option("mode", mode)


def scan_jsonl(
    spark: SparkSession,
    root: str,
    schema: str | T.StructType,
    row_key: bool = False,
    glob: str = "*.jsonl",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Every ``*.jsonl`` below ``root`` at any depth (``**/*.jsonl``).

    A ``**`` in a Hadoop glob is not recursive, so the reader's own recursion is used.
    The schema is required: inference would read the whole corpus once more. A broken line
    is an error; with ``mode="PERMISSIVE"`` it is a row of nulls.
    """
    df = (
        _json_reader(spark, schema, mode, row_key)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .json(root)
    )
    return with_row_key(df, "json") if row_key else df


def scan_files(
    spark: SparkSession,
    paths: list[str],
    schema: str | T.StructType,
    row_key: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """An explicit list of JSON-lines files as one split."""
    df = _json_reader(spark, schema, mode, row_key).json(paths)
    return with_row_key(df, "json") if row_key else df


@dataclass(frozen=True)
class Source:
    """One entry of a :class:`Catalog`. ``path`` may use ``{config}``; ``splits`` maps a
    split name to a SQL predicate, so that picking a split is a pushed-down filter."""

    path: str
    fmt: str = "parquet"
    schema: str | T.StructType | None = None
    splits: dict[str, str] = field(default_factory=dict)


@dataclass
class Catalog:
    """Named sources, looked up by ``load_source``."""

    sources: dict[str, Source] = field(default_factory=dict)

    def register(self, name: str, source: Source) -> Catalog:
        self.sources[name] = source
        return self

    def load_source(
        self, spark: SparkSession, name: str, config: str = "", split: str | None = None
    ) -> DataFrame:
        """Rows of a registered source, or of a catalog table if none is registered."""
        if name not in self.sources:
            return spark.table(name)
        source = self.sources[name]
        reader = spark.read.format(source.fmt)
        if source.schema is not None:
            reader = reader.schema(source.schema)
        df = reader.load(source.path.format(config=config))
        if split is None or (split == "train" and split not in source.splits):
            return df
        if split not in source.splits:
            raise KeyError(f"{name} has no split {split!r}; known: {sorted(source.splits)}")
        return df.where(source.splits[split])
