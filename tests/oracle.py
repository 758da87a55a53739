"""Run a query on Spark and its SQL twin on DuckDB, and compare whole results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def normal(value):
    """Numbers of either engine in one form; everything else as it is."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value.is_integer() and abs(value) < 2**53 else value
    if type(value).__name__ == "Decimal":
        return normal(float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(normal(row[i]) for i in order) for row in rows), key=repr
    )


def differences(frame, connection, sql: str) -> list[str]:
    """Empty when schema names, row count and all values agree."""
    left = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    right = rows_of([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return [f"columns {left[0]} and {right[0]}"]
    if len(left[1]) != len(right[1]):
        return [f"{len(left[1])} rows and {len(right[1])} rows"]
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return [f"{len(wrong)} of {len(left[1])} rows differ, first {wrong[0]}"] if wrong else []
