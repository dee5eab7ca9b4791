"""Transactions derived from the TPC-H-like `lineitem` table, for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.schema import MAJORITY
from ledgersift.sources.readers import conform


def txn_view(spark: SparkSession, folder: str) -> DataFrame:
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    label = (F.when(part % 50 != 0, MAJORITY).when(part % 100 == 0, "family_a")
             .otherwise("family_b"))
    return conform(spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.concat(F.lit("A"), part.cast("string")).alias("address"),
        F.year("l_shipdate").alias("year"),
        F.dayofyear("l_shipdate").alias("day"),
        F.col("l_quantity").cast("int").alias("length"),
        (F.col("l_discount") + F.col("l_tax")).alias("weight"),
        line.alias("count"),
        F.when(F.col("l_returnflag") == "R", line).otherwise(0).alias("looped"),
        (F.col("l_suppkey") % 7).cast("int").alias("neighbors"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("income"),
        label.alias("label"),
    ))


def dirty_view(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows with null weights, null labels and some rows twice."""
    txn = txn_view(spark, folder)
    dirty = txn.withColumns({
        "weight": F.when(F.col("income") % 97 != 0, F.col("weight")),
        "label": F.when(F.col("income") % 89 != 0, F.col("label")),
    })
    return dirty.unionByName(dirty.filter(F.col("income") % 83 == 0))


def score_view(spark: SparkSession, folder: str) -> DataFrame:
    """A label (1 = majority), a score of 0..99 and a 0/1 prediction taken from a hash."""
    scored = txn_view(spark, folder).select(
        (F.col("label") == MAJORITY).cast("int").alias("label"),
        (F.conv(F.substring(F.md5(F.concat("address", F.col("income").cast("string"))), 1, 8),
                16, 10).cast("bigint") % 100).cast("double").alias("score"),
    )
    return scored.withColumn("prediction", (F.col("score") >= 50).cast("double"))


SEPARABLE_FEATURES = ["signal_a", "signal_b", "count"]


def separable_view(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions with a 0/1 label that two features part by a wide margin.

    Every classifier must predict it, so predictions can be held against the label itself.
    """
    positive = (F.col("looped") > 0).cast("int")
    return txn_view(spark, folder).withColumns({
        "label": positive,
        "signal_a": (positive * 100 + F.col("count")).cast("double"),
        "signal_b": ((1 - positive) * 100 + F.col("count")).cast("double")})
