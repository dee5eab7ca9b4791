"""Projections, filters, flags and set operations on the transaction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersift.operators.duplicates import distinct_rows
from ledgersift.schema import MAJORITY, MINORITY


def drop_nulls(df: DataFrame, how: str = "any") -> DataFrame:
    return df.dropna(how=how)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Each row once; only rows that have a copy are moved."""
    return distinct_rows(df)


def split_by_label(df: DataFrame, majority: str = MAJORITY) -> tuple[DataFrame, DataFrame]:
    """Majority rows and all other labelled rows; a null label is in neither."""
    return df.filter(F.col("label") == majority), df.filter(F.col("label") != majority)


def fraud_flag(majority: str = MAJORITY) -> Column:
    return F.when(F.col("label") == majority, False).otherwise(True)


def flag_fraud(df: DataFrame, majority: str = MAJORITY) -> DataFrame:
    """`fraud`: true unless the label is the majority's; a null label counts as fraud."""
    return df.withColumn("fraud", fraud_flag(majority))


def eda_table(df: DataFrame) -> DataFrame:
    """The flagged table without address and label."""
    return flag_fraud(df).drop("address", "label")


def suspicious(df: DataFrame, weight_cap: float | None = None) -> DataFrame:
    """Fraud rows, optionally only those below a weight."""
    rows = df.filter(F.col("fraud"))
    return rows if weight_cap is None else rows.filter(F.col("weight") < weight_cap)


def relabel_minority(minority: DataFrame) -> DataFrame:
    """Give every row the common minority label."""
    return minority.withColumn("label", F.lit(MINORITY))


def relabel_binary(df: DataFrame, majority: str = MAJORITY) -> DataFrame:
    """Relabel a whole table to two classes; a null label becomes the majority's."""
    return df.withColumn(
        "label", F.when(F.col("label") != majority, MINORITY).otherwise(majority))


def encode_label(df: DataFrame, positive: str = MAJORITY) -> DataFrame:
    """1 for `positive`, 0 for any other label, null for null."""
    return df.withColumn("label", (F.col("label") == positive).cast("int"))


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return a.unionByName(b)


def distinct(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def head(df: DataFrame, n: int, by: list[str] | None = None) -> DataFrame:
    """The first rows in a stated order (by default all columns), so the answer is repeatable."""
    return df.orderBy(*(by or df.columns)).limit(n)
