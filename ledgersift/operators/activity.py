"""Rows per address, attached to every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.operators.stored import stored


def add_num_addresses(df: DataFrame, key: str = "address", out: str = "num_addresses") -> DataFrame:
    """The number of rows with the same address; 0 for a null address.

    The addresses are counted with partial counts before the shuffle, and the counts of those that occur
    more than once are stored and joined back: two scans. Few counts are sent to all tasks. Many are
    joined by address; as they come from a table and not from the aggregate, Spark may split the rows of
    a busy address over several tasks, which a window by address could not do.
    """
    counts = stored(
        df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_counted"))
        .agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1"), "address-counts")
    joined = df.join(counts, F.col(key) == F.col("_counted"), "left")
    alone = F.when(F.col(key).isNull(), 0).otherwise(1).cast("bigint")
    return joined.select(*df.columns, F.coalesce("_rows", alone).alias(out))
