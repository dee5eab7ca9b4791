"""Exact deduplication by progressive refinement.

Rows are grouped by normalised length, then by a hash of length and prefix, then by the full hash and
the content itself. Each level looks only at rows whose group of the level before has two rows or
more, so the full content is hashed and compared for likely copies only. Everything is an aggregate
with map-side combining or a join that adaptive execution may split, so a text held by a third of all
rows is one row per task after the first step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import row_hash, stage_keys, without_rows

SPACE_RUN = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def repeated_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """(text_sha256, keep_id, group_size): one row per normalised text held by two rows or more."""
    norm = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_norm"))
    length = F.length("_norm")
    signed = norm.select(length.alias("_len"), F.xxhash64(
        length, F.substring("_norm", 1, prefix_chars)).alias("_pre"))
    lengths = stage_keys(signed.groupBy("_len").agg(F.count(F.lit(1)).alias("_rows"))
                         .filter("_rows > 1").select("_len"), "lengths")
    prefixes = stage_keys(signed.join(lengths, "_len", "left_semi")
                          .groupBy("_pre").agg(F.count(F.lit(1)).alias("_rows"))
                          .filter("_rows > 1").select("_pre"), "prefixes")
    likely = norm.withColumn("_pre", F.xxhash64(
        length, F.substring("_norm", 1, prefix_chars))).join(prefixes, "_pre", "left_semi")
    return (likely.groupBy(F.sha2("_norm", 256).alias("text_sha256"), "_norm")
            .agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .filter("group_size > 1").select("text_sha256", "keep_id", "group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per input row.

    The row with the smallest id of each group of equal normalised texts stays. A null text is an
    empty one. Null ids sort last: they stay only in a group without other ids (`keep_id` is null
    then). Rows that repeat the id that stays are the same document and stay with it. Other columns
    of `docs` are not read, whatever their names; an empty table gives no rows.
    """
    groups = repeated_texts(docs, id_col, text_col).select(
        F.col("text_sha256").alias("_sha"), "keep_id", "group_size")
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"))
    found = rows.join(groups, F.col("text_sha256") == F.col("_sha"), "left")
    keep = F.when(F.col("_sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows that `exact_dedup` would not keep; all columns stay."""
    groups = repeated_texts(docs, id_col, text_col).select(
        F.col("text_sha256").alias("_sha"), F.col("keep_id").alias("_keep"))
    rows = docs.select(F.col(id_col).alias("_id"), row_hash(F.col(text_col)).alias("_row"),
                       F.sha2(normalised(F.col(text_col)), 256).alias("_text"))
    copies = rows.join(groups, F.col("_text") == F.col("_sha")).filter(
        ~F.col("_id").eqNullSafe(F.col("_keep"))).select("_id", "_row")
    return without_rows(docs, copies, id_col, text_col)
