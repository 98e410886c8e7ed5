"""Compare every query with its SQL counterpart: schema shape, row count and values."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pyarrow as pa


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(round(value, 6) + 0.0)
    return value


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns), key=repr)


def _kind(t: pa.DataType) -> str:
    if pa.types.is_integer(t):
        return f"int{t.bit_width}"
    if pa.types.is_floating(t) or pa.types.is_decimal(t):
        return "float"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    return str(t)


def difference(ours: pa.Table, theirs: pa.Table) -> str | None:
    """The first thing that differs, or None."""
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} against {sorted(theirs.column_names)}"
    kinds = {
        n: (_kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type))
        for n in ours.column_names
    }
    odd = {n: k for n, k in kinds.items() if k[0] != k[1]}
    if odd:
        return f"types {odd}"
    if ours.num_rows != theirs.num_rows:
        return f"{ours.num_rows} rows against {theirs.num_rows}"
    for a, b in zip(rows_of(ours), rows_of(theirs)):
        if a != b:
            return f"values {repr(a)[:400]} against {repr(b)[:400]}"
    return None


def main(sf: str, names: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    from corpusloom.session import build_session

    spark = build_session(
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            ours = queries[name](spark, sf).toArrow()
            took = time.time() - start
            if name not in oracles:
                status = "no oracle"
            else:
                status = difference(ours, con.sql(oracles[name]).to_arrow_table()) or "ok"
        except Exception as e:  # noqa: BLE001
            took, status, ours = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}", None
        bad += status not in ("ok", "no oracle")
        print(f"{name:32} {took:6.2f}s {ours.num_rows if ours is not None else '-':>8} {status}", flush=True)
    print(f"{len(names or queries)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
