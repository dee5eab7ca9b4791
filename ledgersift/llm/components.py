"""Connected components by alternating large-star and small-star steps.

Each step is a few joins and aggregates over the edge table; no component is brought into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): root is the least node of the component; nodes without edges left out."""
    a, b = edges.columns
    now = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .filter("u <> v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = stage(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(now.select("v", "v").distinct()))
