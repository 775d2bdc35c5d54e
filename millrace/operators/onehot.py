"""Indicator columns for string categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def categories(df: DataFrame, column: str) -> list[str]:
    """Distinct values in value order; each becomes a column of the plan, so they all reach the driver."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in found)


def signed_one_hot(
    df: DataFrame, columns: Sequence[str], values: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Each string column becomes one column per value: 1 where equal, else -1.

    Non-string columns are left alone.  `values` fixes the value lists, for
    scoring data that lacks some of them.
    """
    strings = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    added = {}
    for column in strings:
        for value in (values or {}).get(column) or categories(df, column):
            added[f"{column}_{value}"] = F.when(F.col(column) == value, 1).otherwise(-1)
    return df.withColumns(added).drop(*strings) if added else df
