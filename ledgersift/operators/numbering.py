"""Row numbers 0..n-1, in a stated order or dealt by hash, without sorting everything in one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.functions.hashing import hash_bits
from ledgersift.operators.sizing import small_rows
from ledgersift.session import ensure_checkpoint_dir

BUCKET_ROWS = 100_000   # rows that are put in order together


def number_rows(df: DataFrame, order_by: list[str], out: str = "row_no") -> DataFrame:
    """Add a row number.

    The table is sorted by range, checkpointed so that each row keeps its partition and place,
    and numbered by the sizes of the partitions before theirs. Equal rows may be spread over
    partitions (their order does not matter), so copies of one row do not pile up in a task.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (df.withColumn("_arrival", F.monotonically_increasing_id())
              .orderBy(*order_by, "_arrival").drop("_arrival").checkpoint())
    here = F.spark_partition_id()
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    located = placed.withColumns({"_part": here, "_place": place})
    sizes = sorted(tuple(r) for r in small_rows(
        located.groupBy("_part").agg(F.count(F.lit(1)).alias("n")), "partitions"))
    starts = accumulate([0] + [n for _, n in sizes[:-1]])
    offsets = df.sparkSession.createDataFrame(
        [(p, s) for (p, _), s in zip(sizes, starts)], "_part int, _start bigint")
    return (located.join(F.broadcast(offsets), "_part")
            .select(*df.columns, (F.col("_start") + F.col("_place")).alias(out)))


def number_rows_dealt(df: DataFrame, rows: int, order_by: list[str] | None = None, out: str = "row_no",
                      bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add a row number that depends on the rows' values only, without a sort over the whole table.

    Equal rows are counted first, and more than `bucket_rows` copies are cut into shares, so a row with
    any number of copies is dealt evenly. A hash of a row's columns (floating-point ones only where there
    are no others, as engines print them differently) and of the share's number picks one of
    ceil(`rows` / `bucket_rows`) buckets; within a bucket rows stand in order of `order_by` and then of all
    columns. Numbers follow from the running totals of the buckets. `rows` is the number of rows of `df`.
    """
    floating = (T.DoubleType, T.FloatType)
    exact = [f.name for f in df.schema.fields if not isinstance(f.dataType, floating)] or df.columns
    order = [*(order_by or []), *[c for c in df.columns if c not in (order_by or [])]]
    shares = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn(
        "_share", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {bucket_rows}L)"))).withColumn(
        "_size", F.least(F.lit(bucket_rows), F.col("_copies") - F.col("_share") * bucket_rows))
    buckets = max(1, -(-rows // bucket_rows))
    dealt = shares.withColumn(
        "_bucket", hash_bits([*[F.col(c) for c in exact], F.col("_share")], "deal") % buckets)
    running = (Window.partitionBy("_bucket").orderBy(*order, "_share")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = dealt.withColumn("_end", F.sum("_size").over(running))
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)   # one row per bucket
    starts = dealt.groupBy(F.col("_bucket").alias("_of")).agg(F.sum("_size").alias("_rows")).select(
        "_of", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    numbers = F.expr("sequence(_start + _end - _size, _start + _end - 1)")
    return placed.join(starts, F.col("_bucket") == F.col("_of")).select(
        *df.columns, F.explode(numbers).alias(out))
