"""Scoring of incoming records with a stored model, in batch and as a stream.

A record that cannot be scored (a line that does not parse, or one without a feature) does not stop a
stream: it goes to a table of its own with the reason.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from ledgersift.functions.features import positive_score

LINE = "bad_line"       # the text of a line that does not parse
REASON = "reason"
BATCH = "batch_id"


def score(model: PipelineModel, records: DataFrame) -> DataFrame:
    """The records with `prediction` and the `score` of class 1; works on streams as well.

    A null or NaN feature is an error.
    """
    return positive_score(model.transform(records)).drop(
        "features", "rawPrediction", "probability")


def input_columns(model: PipelineModel) -> list[str]:
    """The columns that the model's assembler reads."""
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def refusal(records: DataFrame, features: list[str]) -> Column:
    """Why a record cannot be scored: the features it lacks, or that its line does not parse; else null."""
    def lacks(name: str) -> Column:
        gone = F.col(name).isNull()
        if isinstance(records.schema[name].dataType, (T.DoubleType, T.FloatType)):
            gone = gone | F.isnan(name)
        return F.when(gone, F.lit(name))

    missing = F.concat_ws(", ", *[lacks(c) for c in features])
    reason = F.when(missing != "", F.concat(F.lit("without "), missing))
    if LINE in records.columns:
        reason = F.when(F.col(LINE).isNotNull(), F.lit("does not parse")).otherwise(reason)
    return reason


def split_records(model: PipelineModel, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that can be scored, the others with `reason`); every record is in one of them."""
    marked = records.withColumn(REASON, refusal(records, input_columns(model)))
    good = marked.filter(F.col(REASON).isNull()).drop(REASON, LINE)
    return good, marked.filter(F.col(REASON).isNotNull())


def read_request_stream(spark: SparkSession, path: str, schema: T.StructType,
                        files_per_batch: int | None = None) -> DataFrame:
    """JSON-lines files as they arrive in a folder; `bad_line` holds the text of lines that do not parse."""
    reader = (spark.readStream.schema(T.StructType([*schema.fields, T.StructField(LINE, T.StringType())]))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def score_stream(model: PipelineModel, records: DataFrame, out: str, checkpoint: str,
                 trigger: dict | None = None, rejected: str | None = None) -> StreamingQuery:
    """Append scored records to Parquet at `out`, and those that cannot be scored at `rejected`.

    Each batch overwrites its own folder of either table, named by the batch's number, and the checkpoint
    gives a batch that is run again the same number and the same files. So a restart continues where it
    stopped and writes nothing twice, also after a failure between writing and committing. `rejected`
    is by default beside `out`. The default trigger works through what is there and stops.
    """
    aside = rejected or rejected_path(out)

    def write(batch: DataFrame, number: int) -> None:
        # parsed once for both tables
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = split_records(model, held)
            score(model, good).write.mode("overwrite").parquet(f"{out}/{BATCH}={number}")
            bad.write.mode("overwrite").parquet(f"{aside}/{BATCH}={number}")
        finally:
            held.unpersist()

    return (records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def rejected_path(out: str) -> str:
    return out.rstrip("/") + "-rejected"


def read_scored(spark: SparkSession, out: str) -> DataFrame:
    """What `score_stream` has written, without the numbers of the batches."""
    return spark.read.parquet(out).drop(BATCH)
