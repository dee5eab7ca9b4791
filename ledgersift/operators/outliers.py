"""Z-score outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zscore(df: DataFrame, column: str, ddof: int = 1) -> DataFrame:
    """Add `z_<column>` by the sample (ddof=1) or population (ddof=0) standard deviation.

    Mean and deviation are scalar subqueries on one aggregate; z is null where all values are equal.
    """
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    stats = df.agg(F.mean(column).alias("mean"), std(column).alias("std"))
    return df.withColumn(f"z_{column}", F.try_divide(
        F.col(column) - stats.select("mean").scalar(), stats.select("std").scalar()))


def outliers(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """Rows whose z-score is further from zero than the threshold."""
    return df.filter(F.abs(F.col(f"z_{column}")) > threshold)


def outlier_points(df: DataFrame, column: str, threshold: float = 3.0, ddof: int = 1) -> DataFrame:
    """Every value with its outlier flag, the data behind the outlier scatter."""
    return zscore(df, column, ddof).select(
        column, F.coalesce(F.abs(F.col(f"z_{column}")) > threshold, F.lit(False))
        .alias("is_outlier"))
