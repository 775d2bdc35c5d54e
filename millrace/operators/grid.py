"""Cells on a two-dimensional grid: neighbour counts, rules, rebuilt rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.strings import grid_rows

ROW_PIECE = 1024  # cells joined into one string before a whole row is assembled


def cells_from_text(df: DataFrame, text: str) -> DataFrame:
    """Digit text to cells (x, y, alive)."""
    rows = df.select("*", F.posexplode(grid_rows(F.col(text))).alias("y", "_row"))
    side = F.sequence(F.lit(0), F.length("_row") - 1)
    cells = rows.withColumn("x", F.explode(side))
    return cells.withColumn("alive", F.substring("_row", F.col("x") + 1, F.lit(1)) == "1").drop("_row", text)


def neighbour_counts(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Living neighbours of each cell among its eight; outside the grid counts as dead.

    Only living cells are sent to their neighbours, eight rows each, and counts
    combine before the shuffle.
    """
    keys = [*(by or []), "x", "y"]
    # The eight offsets around a cell.
    offsets = [(-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)]
    reached = F.array(
        *[F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")) for dx, dy in offsets]
    )
    counts = (
        cells.where("alive")
        .select(*(by or []), F.inline(reached))
        .groupBy(*keys)
        .agg(F.count("*").alias("_n"))
    )
    return (
        cells.join(counts, keys, "left")
        .withColumn("neighbors", F.coalesce("_n", F.lit(0)).cast("int"))
        .drop("_n")
    )


def next_state(alive: Column, neighbors: Column) -> tuple[Column, Column]:
    """Rule that applies to a cell, and whether it lives on: five disjoint cases in one pass."""
    rule = (
        F.when(alive & (neighbors < 2), "isolate")
        .when(alive & (neighbors > 3), "crowd")
        .when(alive, "survive")
        .when(neighbors == 3, "reproduce")
        .otherwise("ignore")
    )
    return rule, rule.isin("survive", "reproduce")


def classify_cells(cells: DataFrame) -> DataFrame:
    rule, lives = next_state(F.col("alive"), F.col("neighbors"))
    return cells.withColumns({"rule": rule, "alive_next": lives})


def append_generation(rows: DataFrame, path: str, tick: int) -> None:
    """Add one generation of rows to a history folder; a repeated tick replaces itself."""
    rows.write.mode("overwrite").parquet(f"{path}/tick={tick}")


def read_history(spark: SparkSession, path: str, schema: str = "y int, cells string") -> DataFrame:
    return spark.read.schema(f"{schema}, tick int").parquet(path)


def latest_generation(history: DataFrame) -> DataFrame:
    """Rows of the highest tick; folder names alone decide which files are read."""
    return history.where(F.col("tick") == history.agg(F.max("tick")).scalar())


def rows_from_cells(cells: DataFrame, alive: str = "alive", by: list[str] | None = None) -> DataFrame:
    """Row strings such as '0110', cells in x order.

    Strings are built in two steps, so the first shuffle spreads a wide row over
    pieces and the second carries one short string per piece.
    """
    keys = [*(by or []), "y"]

    def glue(at: str, part: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), F.col(part).alias("part"))))
        return F.array_join(F.transform(ordered, lambda c: c["part"]), "")

    return (
        cells.withColumns(
            {
                "_piece": F.floor(F.col("x") / ROW_PIECE),
                "_bit": F.when(F.col(alive), "1").otherwise("0"),
            }
        )
        .groupBy(*keys, "_piece")
        .agg(glue("x", "_bit").alias("_text"))
        .groupBy(*keys)
        .agg(glue("_piece", "_text").alias("cells"))
    )
