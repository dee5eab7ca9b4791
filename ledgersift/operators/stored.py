"""Stage tables: results written to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgersift.session import work_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it again.

    This cuts lineage, survives lost executors, and frees the reader from the writer's partitioning: an
    aggregate that is joined by its own key ties both sides to one partition per key, while a stored
    one may be sent to all tasks where it is small and otherwise leaves Spark free to split a hot key.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
