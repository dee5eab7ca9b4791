"""Tables of columns, bins and curves that are small by their nature, and values by column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The most rows of aggregate results brought to the driver (columns, bins, curves, partitions).
SMALL_ROWS = 100_000


def small_table(df: DataFrame, what: str, limit: int = SMALL_ROWS) -> DataFrame:
    """Evaluate an aggregate once and hand it back as a local table that is safe to broadcast.

    Raises when there are more rows than `limit`: the caller grouped by something that is not a
    class, column or bin.
    """
    return local_table(df, small_rows(df, what, limit))


def small_rows(df: DataFrame, what: str, limit: int = SMALL_ROWS) -> list:
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows, too many for a small table")
    return rows


def local_table(df: DataFrame, rows: list) -> DataFrame:
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], df.schema)


def rows_from_columns(row: DataFrame, columns: list[str], values: dict[str, dict[str, Column]],
                      name: str = "column") -> DataFrame:
    """Turn a one-row aggregate into one row per column.

    `values[out][column]` is the expression that gives field `out` for `column`.
    """
    entries = [
        F.struct(F.lit(c).alias(name), *[values[out][c].alias(out) for out in values])
        for c in columns
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def long_values(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """(keep..., column, x): one row per non-null value, as double."""
    keep = keep or []
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
               for c in columns]
    return (df.select(*keep, F.explode(F.array(*entries)).alias("e"))
            .select(*keep, "e.column", "e.x").filter(F.col("x").isNotNull()))
