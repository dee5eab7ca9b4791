"""Distinct rows without moving the rows that have no copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.operators.stored import stored


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each row once; nulls equal nulls, NaN equals NaN and -0.0 equals 0.0.

    Hashes of whole rows are counted first, so that one number per row is shuffled. A row whose hash
    occurs once has no copy and stays where it is. Only rows with a repeated hash are grouped by all
    their columns, copies of one task being merged before the shuffle, so equal hashes of unequal rows
    do no harm. The repeated hashes are stored: few are sent to all tasks, many are joined by hash.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    hashed = df.withColumn("_row_hash", row)
    again = stored(hashed.groupBy("_row_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                   .select("_row_hash"), "repeated-rows")
    alone = hashed.join(again, "_row_hash", "left_anti").drop("_row_hash")
    merged = hashed.join(again, "_row_hash", "left_semi").drop("_row_hash").distinct()
    return alone.unionByName(merged)
