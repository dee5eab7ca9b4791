"""Stage tables and small report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Overwrite a stage with Parquet and return it read back, so later steps start from files."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Overwrite a report with one CSV file.

    For tables whose length is fixed by the number of features, models, bins or classes.
    """
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
