"""Helpers shared by the text operators: inputs, stage tables and row keys."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersift.session import work_folder


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it again: cuts lineage, survives lost executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_keys(df: DataFrame, name: str) -> DataFrame:
    """A stored table of keys to join with.

    Joined as it comes from an aggregate, it would tie both sides to one partition per key; read from
    the store, Spark sends it to all tasks if it is small and otherwise may split a hot key's rows.
    """
    return stage(df, name)


def utf8(text: Column) -> Column:
    """The text's UTF-8 bytes, empty for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def row_hash(text: Column) -> Column:
    """Tells rows apart that share an id: a hash of the text, null kept apart from empty."""
    return F.when(text.isNull(), F.lit(-1)).otherwise(F.xxhash64(text))


def without_rows(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """`docs` without the rows named in `dropped` (`_id`, `_row`: id and `row_hash`).

    All columns of `docs` stay as they are. Ids may be null or repeat.
    """
    gone = dropped.select(F.col("_id").alias("_gone_id"), F.col("_row").alias("_gone_row")).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone_id"])
                     & (row_hash(docs[text_col]) == gone["_gone_row"]), "left_anti")


def pieces(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that none much exceeds `limit` bytes; one long row stays whole."""
    for batch in batches:
        if batch.nbytes <= limit or batch.num_rows < 2:
            yield batch
            continue
        step = max(1, batch.num_rows * limit // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
