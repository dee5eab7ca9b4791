"""Class balancing by repetition and by SMOTE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.functions.hashing import hash_bits, hash_fraction
from ledgersift.operators.neighbors import BLOCK_ROWS, nearest_neighbors
from ledgersift.operators.numbering import number_rows, number_rows_dealt
from ledgersift.operators.sizing import small_rows

SEED = 42  # fixed value


def _deficits(df: DataFrame, target: str) -> list[tuple]:
    """(class, rows, missing rows) of every class that is not the largest; null is no class."""
    counts = small_rows(df.filter(F.col(target).isNotNull()).groupBy(target).agg(
        F.count(F.lit(1)).alias("n")), f"classes of {target}")
    top = max((r["n"] for r in counts), default=0)
    return sorted((r[target], r["n"], top - r["n"]) for r in counts if r["n"] < top)


def _stream(seed: int, cls) -> str:
    return f"{seed}-{str(cls).lower()}"


def random_oversample(df: DataFrame, target: str, seed: int = SEED,
                      order_by: list[str] | None = None) -> DataFrame:
    """Add minority rows drawn with replacement until every class has as many rows as the largest.

    Each draw is one row of a range and picks a row number by hash, so the draws are spread evenly
    whatever the number of minority rows. They are joined on the row number, where no number is drawn
    unusually often. Numbers are dealt by hash in buckets, so the class is neither sorted as a whole nor
    stored, and a bucket gets draws in proportion to its rows. Draws depend on the rows' values alone.
    """
    out = df
    for cls, rows, missing in _deficits(df, target):
        numbered = number_rows_dealt(df.filter(F.col(target) == cls), rows, order_by)
        draws = df.sparkSession.range(missing).select(
            (hash_bits([F.col("id")], _stream(seed, cls)) % rows).alias("row_no"))
        out = out.unionByName(draws.join(numbered, "row_no").select(*df.columns))
    return out


def smote(df: DataFrame, features: list[str], target: str, k: int = 5, seed: int = SEED,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add synthetic minority rows until every class has as many rows as the largest.

    A synthetic row is x + u (neighbour - x): x a minority row, the neighbour one of its
    min(k, rows - 1) nearest in its class by Euclidean distance over the raw features, u in [0, 1).
    Whole-number features are cut back to their type. Returns features and target.
    """
    out = df.select(*features, target)
    for cls, rows, missing in _deficits(df, target):
        near = min(k, rows - 1)
        if near < 1:
            raise ValueError(f"class {cls!r} has one row, so no neighbour to interpolate with")
        points = df.filter(F.col(target) == cls).select(
            *[F.col(f).cast("double").alias(f) for f in features])
        wide = _widest_first(points, features)
        numbered = number_rows(points, wide)
        parents = parent_pairs(numbered, wide, near, block_rows)
        stream = _stream(seed, cls)
        draws = df.sparkSession.range(missing).select(
            (hash_bits([F.col("id")], f"{stream}-row") % rows).alias("row_no"),
            (hash_bits([F.col("id")], f"{stream}-near") % near).cast("int").alias("pick"),
            hash_fraction([F.col("id")], f"{stream}-step").alias("u"))
        made = draws.join(parents, ["row_no", "pick"]).select(
            *[(F.col(f) + F.col("u") * (F.col(f"near_{f}") - F.col(f)))
              .cast(df.schema[f].dataType).alias(f) for f in features],
            F.lit(cls).cast(df.schema[target].dataType).alias(target))
        out = out.unionByName(made)
    return out


def _widest_first(points: DataFrame, features: list[str]) -> list[str]:
    """Features by falling spread: the first one then separates distant rows best."""
    spread = points.agg(*[F.stddev_pop(f).alias(f) for f in features]).first()
    return sorted(features, key=lambda f: (-(spread[f] or 0.0), f))


def parent_pairs(numbered: DataFrame, features: list[str], k: int,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(row_no, pick, features..., near_features...): each row with each of its k neighbours."""
    pairs = nearest_neighbors(numbered, features, k, block_rows)
    other = numbered.select(F.col("row_no").alias("near_no"),
                            *[F.col(f).alias(f"near_{f}") for f in features])
    return (pairs.join(numbered, "row_no").join(other, "near_no")
            .select("row_no", "pick", *features, *[f"near_{f}" for f in features]))
