"""Side-by-side comparison of a bound query with its DuckDB oracle."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

from millrace.sources.tables import NAMES


def connect(root: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else value
    return value


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_plain(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


# Spark and DuckDB names of the same column type.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable differences; empty when both agree."""
    relation = connection.sql(sql)
    expected_types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    got_types = {c: TYPES.get(t, t) for c, t in result.dtypes}
    problems = []
    if got_types != expected_types:
        problems.append(f"schema {got_types} != {expected_types}")
        if set(got_types) != set(expected_types):
            return problems
    names = sorted(relation.columns)
    got = sorted((tuple(_plain(r[n]) for n in names) for r in result.collect()), key=repr)
    position = [relation.columns.index(n) for n in names]
    expected = sorted(
        (tuple(_plain(row[i]) for i in position) for row in relation.fetchall()), key=repr
    )
    if len(got) != len(expected):
        problems.append(f"{len(got)} rows != {len(expected)}")
    if got != expected:
        wrong = [(g, e) for g, e in zip(got, expected) if g != e][:3]
        problems.append(f"first differing rows (spark, oracle): {wrong}")
    if not expected:
        problems.append("oracle result is empty")
    return problems
