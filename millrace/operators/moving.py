"""Lagged moving averages over a month-partitioned daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from millrace.sources.storage import materialize

# The averaging windows, in rows.
WINDOWS = (1, 5, 10, 15)


def daily_series(df: DataFrame, at: str, value: str) -> DataFrame:
    """One row per day, so a month never holds more than 31 rows."""
    return df.groupBy(F.col(at).cast("date").alias("day")).agg(F.sum(value).alias("value"))


def with_previous_month(daily: DataFrame) -> DataFrame:
    """Each row once for its own month and once as history of the month after it."""
    month = F.trunc("day", "MM")
    targets = F.array(
        F.struct(month.alias("month"), F.lit(True).alias("current")),
        F.struct(F.add_months(month, 1).alias("month"), F.lit(False).alias("current")),
    )
    return daily.select("day", "value", F.inline(targets))


def lagged_averages(
    daily: DataFrame, windows: Sequence[int] = WINDOWS, start: str = "00000000"
) -> DataFrame:
    """Means over the last w rows before each row, restarted per month on one month of history.

    A window that is not full gives NULL.  The first month of the series has no
    history and is skipped; months before `start` (YYYYMMDD) are left out.
    """
    # At most one row per day: worth writing before the first month is looked up.
    daily = materialize(daily.select("day", "value"), "daily")
    first = daily.agg(F.min(F.trunc("day", "MM"))).scalar()
    by_day = Window.partitionBy("month").orderBy("day")
    averages = {}
    for w in windows:
        frame = by_day.rowsBetween(-w, -1)
        averages[f"avg_{w}"] = F.when(F.count("value").over(frame) == w, F.avg("value").over(frame))
    return (
        with_previous_month(daily)
        .withColumns(averages)
        .where(F.col("current") & (F.col("month") > first))
        .where(F.date_format("month", "yyyyMM") >= start[:6])
        .select(
            F.date_format("month", "yyyyMM").alias("yyyymm"),
            "day",
            *averages,
            F.col("value").alias("y"),
        )
    )


def training_rows(daily: DataFrame, windows: Sequence[int] = WINDOWS, start: str = "00000000") -> DataFrame:
    """Lagged averages with every window full."""
    return lagged_averages(daily, windows, start).na.drop("any")
