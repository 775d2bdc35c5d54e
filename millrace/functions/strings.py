"""String, path and text-grid expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def year_month(text: Column) -> Column:
    """'YYYY-MM-DD' (or 'YYYYMMDD') text to 'YYYYMM'."""
    return F.substring(F.replace(text, F.lit("-"), F.lit("")), 1, 6)


def zero_pad(text: Column, width: int) -> Column:
    """Left-pad with zeros; unlike lpad alone, longer input is kept whole."""
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_name(path: Column) -> Column:
    """Name of the folder a path lies in."""
    return F.get(F.split(path, "/"), F.size(F.split(path, "/")) - 2)


def strip_suffix(name: Column) -> Column:
    """Drop the last '.suffix' of a file name."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def shard_bucket(name: Column) -> Column:
    """Group four-digit shard names by their first two digits: 3554 -> 35__."""
    return F.regexp_replace(name, r"(\d\d)\d\d", "$1__")


def first_number(text: Column) -> Column:
    """First run of digits as text, NULL when there is none."""
    found = F.regexp_extract(text, "[0-9]+", 0)
    return F.when(found != "", found)


def first_url(text: Column) -> Column:
    found = F.regexp_extract(text, "https?://[^ ]*", 0)
    return F.when(found != "", found)


def cut(text: Column, delimiter: str, field: int) -> Column:
    """One-based field of delimited text; text without the delimiter is kept whole."""
    parts = F.split(text, F.lit(delimiter) if len(delimiter) > 1 else f"[{delimiter}]")
    return F.when(F.size(parts) == 1, text).otherwise(F.coalesce(F.get(parts, F.lit(field - 1)), F.lit("")))


def delete_characters(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def grid_rows(text: Column) -> Column:
    """Keep only 0 and 1, then cut into rows as wide as the square root of the length.

    A length that is no square leaves a shorter last row.
    """
    cells = F.regexp_replace(text, "[^01]", "")
    side = F.floor(F.sqrt(F.length(cells))).cast("int")
    starts = F.sequence(F.lit(1), F.length(cells), F.greatest(side, F.lit(1)))
    rows = F.transform(starts, lambda at: F.substring(cells, at, side))
    return F.when(F.length(cells) > 0, rows).otherwise(F.array().cast("array<string>"))


def md5_modulus(name: Column, n: int) -> Column:
    """md5 of a name, read as a 128-bit number, modulo n.

    The number fits no Spark integer, so it is folded 16 bits at a time.
    """
    digest = F.md5(name)
    chunks = F.sequence(F.lit(1), F.lit(29), F.lit(4))
    return F.aggregate(
        chunks,
        F.lit(0).cast("bigint"),
        lambda rest, at: (rest * 65536 + F.conv(F.substring(digest, at, F.lit(4)), 16, 10).cast("bigint")) % n,
    )
