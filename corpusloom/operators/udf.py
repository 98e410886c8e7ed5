"""Slots for user functions. Library operators use built-in expressions instead.

Data moves in Arrow batches; the functions see plain Python values, null as None.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.operators.ordering import plan_segments


def _struct(df: DataFrame, schema: str | T.StructType) -> T.StructType:
    return df.sparkSession.createDataFrame([], schema).schema


def map_batches(
    df: DataFrame,
    fn: Callable[[dict[str, list]], dict[str, list]],
    schema: str | T.StructType,
    columns: list[str] | None = None,
    order: str | None = None,
    batch_rows: int | None = None,
    **options,
) -> DataFrame:
    """``fn`` over batches given as column -> list; it may change the number of rows.

    Only ``columns`` are sent to Python. With ``order`` and ``batch_rows`` a batch is that many
    consecutive rows in that order, the last one the rest, and ``batch_id`` is among its columns;
    a batch is in one task, so it has to fit there. ``options`` are those of
    :func:`~corpusloom.operators.ordering.plan_segments`. Without them the batch is whatever Arrow delivers
    (``spark.sql.execution.arrow.maxRecordsPerBatch``), so results must not depend on it.
    """
    if (order is None) != (batch_rows is None):
        raise ValueError("order and batch_rows go together")
    result = _struct(df, schema)
    arrow_schema = to_arrow_schema(result)
    if order is not None:
        names = columns or df.columns
        plan = plan_segments(df, order, batch_rows, **options)
        source = plan.attach(df.select(*dict.fromkeys([*names, order])), plan.places.drop("n", "start"))

        def run_batch(table: pa.Table) -> pa.Table:
            table = table.sort_by("batch_row").select([*names, "batch_id"])
            return pa.Table.from_pydict(fn(table.to_pydict()), schema=arrow_schema)

        return source.groupBy(*plan.batch_keys).applyInArrow(run_batch, result)
    source = df.select(*columns) if columns else df

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict(fn(batch.to_pydict()), schema=arrow_schema)

    return source.mapInArrow(run, result)


def map_batch_chunks(
    df: DataFrame,
    fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
    schema: str | T.StructType,
    order: str,
    batch_rows: int,
    columns: list[str] | None = None,
    **options,
) -> DataFrame:
    """:func:`map_batches` for batches larger than a task's memory: ``fn`` gets the batch as an iterator of chunks, its
    rows in order, and yields chunks of results.

    A chunk has at most ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows. The batch is sorted by Spark, which
    spills; in Python there is a chunk at a time, and what ``fn`` keeps. Besides ``columns`` a chunk has ``batch_id`` and
    ``batch_row``. ``fn`` need not read on to the end.
    """
    result = _struct(df, schema)
    arrow_schema = to_arrow_schema(result)
    names = columns or df.columns
    plan = plan_segments(df, order, batch_rows, **options)
    placed = plan.attach(df.select(*dict.fromkeys([*names, order])), plan.places.drop("n", "start"))
    if plan.split:
        placed = placed.repartition("batch_id")
    # Grouping needs its keys in order only, so it keeps the rows as they are sorted here.
    in_order = placed.sortWithinPartitions(*plan.batch_keys, "batch_row")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        expected = 0
        for batch in batches:
            if batch.num_rows and batch.column("batch_row")[0].as_py() != expected:
                raise RuntimeError("the rows of a batch are not in order")
            expected += batch.num_rows
            yield batch.select([*names, "batch_id", "batch_row"]).to_pydict()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in fn(chunks(batches)):
            yield pa.RecordBatch.from_pydict(found, schema=arrow_schema)

    return in_order.groupBy(*plan.batch_keys).applyInArrow(run, result)


def map_rows(
    df: DataFrame,
    fn: Callable,
    columns: list[str],
    output: str,
    output_type: str | T.DataType,
) -> DataFrame:
    """Add ``output`` = ``fn(*columns)`` row by row."""
    if isinstance(output_type, str):
        output_type = _struct(df, f"`{output}` {output_type}")[0].dataType
    arrow_type = to_arrow_schema(T.StructType().add(output, output_type)).field(0).type

    @F.arrow_udf(output_type)
    def run(*arrays: pa.Array) -> pa.Array:
        rows = zip(*[a.to_pylist() for a in arrays])
        return pa.array([fn(*values) for values in rows], arrow_type)

    return df.withColumn(output, run(*columns))


def filter_rows(df: DataFrame, predicate: Callable[..., bool], columns: list[str]) -> DataFrame:
    """Rows for which ``predicate(*columns)`` is true."""

    @F.arrow_udf("boolean")
    def run(*arrays: pa.Array) -> pa.Array:
        rows = zip(*[a.to_pylist() for a in arrays])
        return pa.array([bool(predicate(*values)) for values in rows], pa.bool_())

    return df.where(run(*columns))
