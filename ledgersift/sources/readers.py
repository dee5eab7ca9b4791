"""Batch sources for transactions and scoring requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.schema import TXN


def conform(df: DataFrame, schema: T.StructType = TXN) -> DataFrame:
    """Select the declared columns, casting only those whose stored type differs.

    An unchanged column stays a bare attribute, so filters on it still reach the Parquet scan. A
    value that does not fit the declared type is an error under ANSI mode, not a silent NULL.
    """
    return df.select(*[
        F.col(f.name) if df.schema[f.name].dataType == f.dataType
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def read_txn(spark: SparkSession, path: str, row_id: bool = False) -> DataFrame:
    """Transactions from Parquet at any Hadoop path.

    `row_id=True` adds a string naming the file and the position in it, a sampling key that tells
    equal rows apart and does not depend on how the file is split.
    """
    raw = spark.read.parquet(path)
    if not row_id:
        return conform(raw)
    raw = raw.withColumn(
        "row_id", F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    return conform(raw, T.StructType(TXN.fields + [T.StructField("row_id", T.StringType())]))


def read_txn_csv(spark: SparkSession, path: str, index: bool = True) -> DataFrame:
    """Transactions from CSV with a header; `index` says an unnamed row index comes first.

    The schema is declared, so the file is not read twice to guess types, and a value that does
    not parse stops the job.
    """
    fields = ([T.StructField("_c0", T.StringType())] if index else []) + TXN.fields
    raw = (spark.read.option("header", True).option("mode", "FAILFAST")
           .schema(T.StructType(fields)).csv(path))
    return raw.drop("_c0")


def read_requests(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records to score, as JSON lines."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
