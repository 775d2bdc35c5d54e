"""Registration of bound queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def bound(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `key`, with its oracle where SQL can express it."""

    def register(query: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = dedent(sql).strip()
        return query

    return register


def fixed(value: Column | str, digits: int = 4) -> Column:
    """Round a double for comparison.

    The nudge moves values off exact halves, so two engines that add in another
    order still round the same way; adding zero turns -0.0 into 0.0.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column + F.lit(1e-9), digits) + F.lit(0.0)


def fixed_sql(expression: str, digits: int = 4) -> str:
    """The oracle's form of `fixed`."""
    return f"(round(({expression}) + 1e-9, {digits}) + 0.0)"
