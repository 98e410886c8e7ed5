"""Quality filter, projection and positional access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import PYTHON_WHITESPACE
from corpusloom.operators.ordering import key_at


# What Python's float() reads, in ASCII. A bare cast would also take 0.9f and 0.9d, and
# would not take 1_000.
_DIGITS = r"\d+(?:_\d+)*"
FLOAT_TEXT = (
    rf"(?i)^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf|infinity|nan)$"
)

# float() does not strip the four ASCII separators that str.strip() does.
FLOAT_SPACES = "".join(c for c in PYTHON_WHITESPACE if not "\x1c" <= c <= "\x1f")


def score_value(df: DataFrame, score: str) -> Column:
    """The score as a number; text that is not one gives null instead of failing the job."""
    c = F.col(score)
    if isinstance(df.schema[score].dataType, T.NumericType):
        return c
    text = F.btrim(c, F.lit(FLOAT_SPACES))
    return F.when(text.rlike(FLOAT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def score_filter(df: DataFrame, score: str = "score", minimum: float = 0.85) -> DataFrame:
    """Rows with score >= minimum. NaN fails, as in Python (Spark sorts NaN highest).

    On a numeric column the comparison is pushed into the Parquet scan.
    """
    value = score_value(df, score)
    keep = value >= F.lit(minimum)
    if not isinstance(df.schema[score].dataType, (T.IntegralType, T.DecimalType)):
        keep = keep & ~F.isnan(value)
    return df.where(keep)


def score_rejects(df: DataFrame, score: str = "score", strict: bool = False) -> DataFrame:
    """Rows whose score is missing or not a number. ``strict`` fails on the first."""
    rejects = df.where(score_value(df, score).isNull())
    if strict:
        message = F.concat(F.lit("bad score: "), F.coalesce(F.col(score).cast("string"), F.lit("null")))
        return rejects.withColumn(score, F.raise_error(message).cast(df.schema[score].dataType))
    return rejects


def drop_source_columns(df: DataFrame, source_columns: list[str]) -> DataFrame:
    """Only the columns a step added."""
    return df.drop(*source_columns)


def slice_rows(df: DataFrame, start: int, stop: int | None, order: str) -> DataFrame:
    """Rows ``start`` to before ``stop`` in key order, like a Python slice; ``stop=None`` is
    open. The result itself is not sorted.

    The slice is a filter between two keys, found by comparing keys only and pushed into
    the scan. A sort with limit would have every task send its widest rows to a single one.
    """
    if start > 0:
        first = key_at(df, order, start)
        if first is None:
            return df.limit(0)
        df = df.where(F.col(order) >= F.lit(first))
        stop = None if stop is None else stop - start
    if stop is None:
        return df
    if stop <= 0:
        return df.limit(0)
    end = key_at(df, order, stop)
    return df if end is None else df.where(F.col(order) < F.lit(end))


def take(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first n rows in key order."""
    return slice_rows(df, 0, n, order)


def take_batches(df: DataFrame, last_index: int, batch_rows: int, order: str) -> DataFrame:
    """What a batch loop has consumed when it stops after a batch index above
    ``last_index``: batches 0 to last_index + 1."""
    return take(df, (last_index + 2) * batch_rows, order)


def row_at(df: DataFrame, i: int, order: str) -> DataFrame:
    """The row at 0-based position i in key order; no row past the end."""
    key = key_at(df, order, i)
    return df.limit(0) if key is None else df.where(F.col(order) == F.lit(key))
