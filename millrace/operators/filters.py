"""Row filters, predicates and column edits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from millrace.functions.strings import md5_modulus
from millrace.operators.sequences import with_ordinal


def keep_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose column exists and holds a match of the regex."""
    return df.where(F.col(column).isNotNull() & F.col(column).rlike(pattern))


def contains_pattern(column: Column, pattern: str) -> Column:
    """Regex containment where a missing value counts as no match."""
    return F.coalesce(column.rlike(pattern), F.lit(False))


def first_where(df: DataFrame, condition: Column, order: Sequence[str]) -> DataFrame:
    """First matching row in a stated order, at most one row."""
    return df.where(condition).orderBy(*order).limit(1)


def first_record(df: DataFrame, condition: Column, order: Sequence[str]) -> Row:
    found = first_where(df, condition, order).collect()
    if not found:
        raise LookupError("no row matches")
    return found[0]


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """New columns numerator / denominator; a zero denominator gives NULL."""
    return df.withColumns({name: F.try_divide(F.col(a), F.col(b)) for name, (a, b) in ratios.items()})


def signed(flag: Column) -> Column:
    """0 becomes -1, everything else stays."""
    return F.when(flag == 0, F.lit(-1)).otherwise(flag)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL or NaN."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def keep_entities(long: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    """Entries of a long table whose entity is listed.

    Adaptive execution broadcasts a short list and splits an entity that holds
    most of the entries.
    """
    return long.join(entities.select(key), key, "left_semi")


def by_support(
    long: DataFrame, cell: str, gene: str, min_genes: int, min_cells: int
) -> DataFrame:
    """Cells with enough genes, then genes in enough of the remaining cells."""
    cells = long.groupBy(cell).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_genes)
    # A cell has no more entries than there are genes, so cells cannot be hot.
    kept = long.join(cells.select(cell), cell, "left_semi")
    genes = kept.groupBy(gene).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_cells)
    return keep_entities(kept, genes, gene)


def rename_values(column: Column, names: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others."""
    mapping = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return F.coalesce(F.try_element_at(mapping, column), column)


def hash_shard(df: DataFrame, name: str, shard: int, shards: int) -> DataFrame:
    """Rows of one of `shards` deterministic shards, numbered from 1."""
    if not 1 <= shard <= shards:
        raise ValueError("shard must lie in 1..shards")
    return df.where(md5_modulus(F.col(name), shards) == shard - 1)


def line_matches(line: Column, pattern: str, invert: bool = False, ignore_case: bool = False) -> Column:
    found = line.rlike(f"(?i){pattern}" if ignore_case else pattern)
    return ~found if invert else found


def grep(df: DataFrame, column: str, pattern: str, invert: bool = False, ignore_case: bool = False) -> DataFrame:
    return df.where(line_matches(F.col(column), pattern, invert, ignore_case))


def slice_rows(df: DataFrame, order: Sequence[str], start: int, end: int) -> DataFrame:
    """Rows start (included) to end (excluded) of a stated total order."""
    numbered = with_ordinal(df, order, "_at")
    return numbered.where((F.col("_at") >= start) & (F.col("_at") < end)).drop("_at")
