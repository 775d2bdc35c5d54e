"""Calendar expressions on dates and zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day.cast("date"), "MM")


def month_text(day: Column) -> Column:
    return F.date_format(day.cast("date"), "yyyyMM")


def previous_month(yyyymm: Column) -> Column:
    """'YYYYMM' of the month before, wrapping over the year."""
    first = F.to_date(yyyymm, "yyyyMM")
    return F.date_format(F.add_months(first, -1), "yyyyMM")


def month_days(day: Column) -> Column:
    """All days of the month a date lies in, first to last."""
    date = day.cast("date")
    return F.sequence(F.trunc(date, "MM"), F.last_day(date))


def even_second(at: Column) -> Column:
    """Timestamp cut back to an even second."""
    return F.window(at, "2 seconds")["start"]


def clock_text(at: Column) -> Column:
    """'HH:MM:SS' of a zone-less timestamp, independent of the session zone."""
    return F.substring(at.cast("string"), 12, 8)
