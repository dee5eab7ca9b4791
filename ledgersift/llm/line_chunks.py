"""Removal of repeated multi-line chunks with content-defined boundaries.

Lines are hashed, and a rolling hash over the last few line hashes decides where a chunk ends, so equal
passages fall into equal chunks wherever they stand. Chunks of several lines whose hash occurs again
are compared byte by byte; of equal ones the first stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import pieces, row_hash, stage, stage_keys, utf8

WINDOW = 2         # line hashes in the rolling hash
SPARSITY = 3       # one line in so many ends a chunk
MAX_LINES = 64     # a chunk ends here at the latest
MIN_LINES = 2      # shorter chunks are never removed
BATCH_BYTES = 16 << 20
MASK = (1 << 64) - 1
FACTOR = 0x9E3779B97F4A7C15


def cut_lines(lines: list[bytes], window: int = WINDOW, sparsity: int = SPARSITY,
              max_lines: int = MAX_LINES) -> list[tuple[int, int, int]]:
    """(first line, lines, hash) of each chunk; together they are all lines."""
    chunks, first, rolling, whole = [], 0, 0, 0
    hashes: list[int] = []
    leaving = pow(FACTOR, window, 1 << 64)
    for i, line in enumerate(lines):
        h = xxhash.xxh3_64_intdigest(line)
        hashes.append(h)
        rolling = (rolling * FACTOR + h) & MASK
        if i >= window:
            rolling = (rolling - hashes[i - window] * leaving) & MASK
        whole = (whole * FACTOR + (h ^ (h >> 29)) + 1) & MASK
        mixed = ((rolling ^ (rolling >> 31)) * 0xBF58476D1CE4E5B9 & MASK) >> 33
        if mixed % sparsity == 0 or i - first + 1 == max_lines or i + 1 == len(lines):
            chunks.append((first, i - first + 1, (whole ^ (whole >> 32)) - (1 << 63)))
            first, whole = i + 1, 0
    return chunks


def _hashed(window: int, sparsity: int, max_lines: int, min_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            take, rows = [], []
            for i, text in enumerate(batch.column(2)):
                for first, n, h in cut_lines(text.as_py().split(b"\n"), window, sparsity, max_lines):
                    if n >= min_lines:
                        take.append(i)
                        rows.append((first, n, h))
            if rows:
                ids = pa.array(take)
                first, n, h = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(ids), batch.column(1).take(ids),
                     pa.array(first, pa.int32()), pa.array(n, pa.int32()), pa.array(h, pa.int64())],
                    ["id", "row", "first", "lines", "hash"])

    return run


def _chunk_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, BATCH_BYTES):
        take, first, count, hashes, texts = [], [], [], [], []
        for i, (text, chunks) in enumerate(zip(batch.column(2), batch.column(3).to_pylist())):
            lines = text.as_py().split(b"\n")
            for c in chunks:
                take.append(i)
                first.append(c["first"])
                count.append(c["lines"])
                hashes.append(c["hash"])
                texts.append(b"\n".join(lines[c["first"]:c["first"] + c["lines"]]))
        ids = pa.array(take, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(ids), batch.column(1).take(ids), pa.array(first, pa.int32()),
             pa.array(count, pa.int32()), pa.array(hashes, pa.int64()), pa.array(texts, pa.binary())],
            ["id", "row", "first", "lines", "hash", "chunk"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, BATCH_BYTES):
        kept, total, gone = [], [], []
        for text, cuts in zip(batch.column(2), batch.column(3).to_pylist()):
            lines = text.as_py().split(b"\n")
            drop = {i for c in cuts or [] for i in range(c["first"], c["first"] + c["lines"])}
            kept.append(b"\n".join([x for i, x in enumerate(lines) if i not in drop]))
            total.append(len(lines))
            gone.append(len(drop))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(kept, pa.binary()),
             pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
            ["id", "row", "kept", "n_lines", "n_removed"])


def repeated_chunks(rows: DataFrame, window: int = WINDOW, sparsity: int = SPARSITY,
                    max_lines: int = MAX_LINES, min_lines: int = MIN_LINES) -> DataFrame:
    """(id, row, first, lines): chunks that equal an earlier one. `rows` has (id, row, text as bytes).

    Earlier is by (id, row hash, first line). Rows that repeat both id and text share their chunks, so
    they are told apart by none of them: their chunks stay if they are the first.
    """
    kind = rows.schema["id"].dataType.simpleString()
    chunks = stage(rows.mapInArrow(
        _hashed(window, sparsity, max_lines, min_lines),
        f"id {kind}, row bigint, first int, lines int, hash bigint"), "line-chunks")
    again = stage_keys(chunks.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
                       .filter("n > 1").select("hash"), "chunk-keys")
    wanted = chunks.join(again, "hash", "left_semi").groupBy(
        F.col("id").alias("c_id"), F.col("row").alias("c_row")).agg(
        F.collect_set(F.struct("first", "lines", "hash")).alias("chunks"))
    texts = stage(
        rows.join(wanted, rows["id"].eqNullSafe(wanted["c_id"]) & (rows["row"] == wanted["c_row"]))
        .select("id", "row", "text", "chunks").mapInArrow(
            _chunk_texts, f"id {kind}, row bigint, first int, lines int, hash bigint, chunk binary"),
        "line-chunk-texts")
    # grouped by the bytes themselves: equal hashes of unequal chunks do no harm
    first = stage_keys(
        texts.groupBy(F.col("hash").alias("f_hash"), F.col("chunk").alias("f_chunk")).agg(
            F.min(F.struct("id", "row", "first")).alias("keep"),
            F.count(F.lit(1)).alias("n")).filter("n > 1"), "chunk-firsts")
    same = (texts["hash"] == first["f_hash"]) & (texts["chunk"] == first["f_chunk"])
    return texts.join(first, same).filter(
        ~(F.col("id").eqNullSafe(F.col("keep.id")) & (F.col("row") == F.col("keep.row"))
          & (F.col("first") == F.col("keep.first")))).select("id", "row", "first", "lines")


def remove_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           **sizes) -> DataFrame:
    """(id, row, kept, n_lines, n_removed): one row per input row, `kept` as bytes.

    Lines end at a line feed; a null text is an empty one and has one empty line. Rows that repeat both
    id and text keep or lose the same chunks. Null ids come first. Other columns are not read; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), row_hash(F.col(text_col)).alias("row"),
                       utf8(F.col(text_col)).alias("text"))
    cuts = repeated_chunks(rows, **sizes).groupBy(
        F.col("id").alias("c_id"), F.col("row").alias("c_row")).agg(
        F.collect_set(F.struct("first", "lines")).alias("cuts"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.join(cuts, rows["id"].eqNullSafe(cuts["c_id"]) & (rows["row"] == cuts["c_row"]),
                     "left").select("id", "row", "text", "cuts").mapInArrow(
        _kept, f"id {kind}, row bigint, kept binary, n_lines bigint, n_removed bigint")
