"""Repeatable sampling, majority down-sampling and stratified splits.

A row is kept when the hash of its key columns falls below the fraction, so rows with equal keys
share their fate. Give a key that tells rows apart (such as `row_id` from `read_txn`) where copies
should be drawn one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersift.functions.hashing import hash_below
from ledgersift.schema import KEY_COLUMNS, MAJORITY, MINORITY

SEED = 1024       # fixed value
FRACTION = 0.015  # fixed value: share of the majority that is kept


def drawn(fraction: float, key: Sequence[str] = KEY_COLUMNS, seed: int = SEED) -> Column:
    return hash_below([F.col(c) for c in key], seed, fraction)


def sample(df: DataFrame, fraction: float, key: Sequence[str] = KEY_COLUMNS,
           seed: int = SEED) -> DataFrame:
    """Sample without replacement."""
    return df.filter(drawn(fraction, key, seed))


def downsample_majority(df: DataFrame, fraction: float = FRACTION,
                        key: Sequence[str] = KEY_COLUMNS, seed: int = SEED,
                        majority: str = MAJORITY) -> DataFrame:
    """All minority rows under one label and a sample of the majority, from one scan."""
    label = F.col("label")
    kept = df.filter((label != majority) | ((label == majority) & drawn(fraction, key, seed)))
    return kept.withColumn("label", F.when(label == majority, majority).otherwise(MINORITY))


def split_column(df: DataFrame, target: str = "label", ratios: Sequence[float] = (0.8, 0.2),
                 key: Sequence[str] = KEY_COLUMNS, seed: int = SEED) -> DataFrame:
    """Label rows `train` or `test` within each class; rows with another target are left out."""
    share = ratios[0] / sum(ratios)
    rows = df.filter(F.col(target).isin(0, 1))
    return rows.withColumn("split", F.when(drawn(share, [target, *key], seed), "train")
                           .otherwise("test"))


def stratified_split(df: DataFrame, ratios: Sequence[float] = (0.8, 0.2), target: str = "label",
                     key: Sequence[str] = KEY_COLUMNS, seed: int = SEED,
                     method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """(train, test), split within each class of a 0/1 target.

    `method="random"` uses `randomSplit` per class, whose result depends on the partitioning.
    """
    if method == "random":
        one, zero = (df.filter(F.col(target) == v).randomSplit(list(ratios), seed) for v in (1, 0))
        return one[0].unionByName(zero[0]), one[1].unionByName(zero[1])
    marked = split_column(df, target, ratios, key, seed)
    return (marked.filter(F.col("split") == "train").drop("split"),
            marked.filter(F.col("split") == "test").drop("split"))
