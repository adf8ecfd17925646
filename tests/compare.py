"""Run a query on Spark and its oracle on DuckDB and compare them value by value."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_by_name(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = rows_by_name(names, result.fetchall())
    actual = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e or [type(x) for x in a] != [type(x) for x in e]]
    return f"{len(bad)} of {len(actual)} rows differ, first {bad[0]}" if bad else None
