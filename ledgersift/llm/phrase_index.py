"""Benchmark decontamination over a distributed positional inverted index.

The training text is cut into shards of bounded length. A shard's index has one row per term with the
sorted positions of that term, and one directory row that says where its documents begin; the index is
stored as a table. Test phrases are cut into windows of words. For each window a shard starts from the
postings of its rarest term and intersects them with the offset-adjusted postings of the next rarest,
until the whole phrase is certain; terms are compared as bytes, so a match is exact. Windows are handed
to the shards in blocks of bounded size, whatever the size of the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.common import pieces, row_hash, stage, utf8, without_rows

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_WINDOWS = 50_000   # windows sent to the shards at a time
BATCH_BYTES = 16 << 20
GAP = 64                 # empty positions between documents

# Word bytes stay (A-Z in lower case), all others become a space.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
    for b in range(256))


def split_words(text: bytes) -> list[bytes]:
    """Runs of digits, ASCII letters in lower case and non-ASCII characters."""
    return text.translate(WORD_TABLE).split()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shard_words: int = SHARD_WORDS) -> DataFrame:
    """The stored index: (shard, term, positions) rows, and a directory row per shard.

    A directory row has a null term and (ids, rows, starts, lengths) of the shard's documents.
    """
    source = docs.select(F.col(id_col).alias("id"), row_hash(F.col(text_col)).alias("row"),
                         utf8(F.col(text_col)).alias("text"))
    kind = source.schema["id"].dataType
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("term", T.BinaryType()),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
        T.StructField("ids", T.ArrayType(kind)),
        T.StructField("rows", T.ArrayType(T.LongType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("lengths", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        words, ids, rows, lengths = [], [], [], []
        for batch in pieces(batches, BATCH_BYTES):
            id_type = batch.schema.field("id").type
            for key, row, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                found = split_words(text.as_py())
                ids.append(key.as_py())
                rows.append(row.as_py())
                lengths.append(len(found))
                words += found
                if len(words) >= shard_words:
                    yield from _shard(shard, words, ids, rows, lengths, id_type)
                    shard += 1
                    words, ids, rows, lengths = [], [], [], []
        if ids:
            yield from _shard(shard, words, ids, rows, lengths, id_type)

    return stage(source.mapInArrow(run, schema), "phrase-index")


def _shard(shard: int, words: list, ids: list, rows: list, lengths: list,
           id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    size = np.array(lengths, dtype=np.int64)
    starts = np.cumsum(size + GAP) - size - GAP
    place = (np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(len(words))).astype("i4")
    coded = pa.array(words, pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    terms = coded.dictionary
    ends = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(terms)))])
    postings = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[order]))
    names = ["shard", "term", "positions", "ids", "rows", "starts", "lengths"]
    lists = [pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
    for at in range(0, len(terms), 8192):
        n = min(8192, len(terms) - at)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, shard)), terms.slice(at, n), postings.slice(at, n),
             *[pa.nulls(n, t) for t in lists]], names)
    yield pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.list_(pa.int32())),
         *[pa.array([v], t) for v, t in zip((ids, rows, starts.tolist(), lengths), lists)]], names)


def test_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 width: int = WINDOW) -> DataFrame:
    """(terms, items): each distinct window of `width` words with the items that have it.

    An item with fewer words, but not none, is one window. Items are named by their id as a string,
    a null id by the empty string.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = split_words(text.as_py())
                found = sorted({tuple(words[i:i + width])
                                for i in range(max(1, len(words) - width + 1))}) if words else []
                for at in range(0, len(found), 8192):
                    part = found[at:at + 8192]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(part), pa.string()),
                         pa.array([list(w) for w in part], pa.list_(pa.binary()))],
                        ["item", "terms"])

    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                        utf8(F.col(text_col)).alias("text"))
    return (rows.mapInArrow(run, "item string, terms array<binary>")
            .groupBy("terms").agg(F.array_sort(F.collect_set("item")).alias("items")))


def _exact(window: tuple, postings: dict) -> np.ndarray:
    """Positions at which the phrase begins."""
    lists = sorted((len(postings[t]), i, t) for i, t in enumerate(window))
    _, offset, term = lists[0]
    begin = postings[term] - offset
    for _, offset, term in lists[1:]:
        if not len(begin):
            break
        there = postings[term]
        at = np.searchsorted(there, begin + offset)
        at[at == len(there)] = 0
        begin = begin[there[at] == begin + offset]
    return begin


def _near(window: tuple, postings: dict, slop: int) -> np.ndarray:
    """Occurrences of the rarest term with all others at most len + slop words away, in any order."""
    reach = len(window) + slop
    lists = sorted((len(postings[t]), t) for t in set(window))
    near = postings[lists[0][1]]
    for _, term in lists[1:]:
        there = postings[term]
        lo = np.searchsorted(there, near - reach, side="left")
        hi = np.searchsorted(there, near + reach, side="right")
        near = near[hi > lo]
    return near


def _hits(shard: pd.DataFrame, windows: list, slop: int | None) -> pd.DataFrame:
    """(id, row, hit, items) for the documents of one shard that have a window."""
    directory = shard[shard["term"].isna()].iloc[0]
    starts = np.asarray(directory["starts"], dtype=np.int64)
    lengths = np.asarray(directory["lengths"], dtype=np.int64)
    held = shard[shard["term"].notna()]
    postings = {bytes(t): np.asarray(p, dtype=np.int64)
                for t, p in zip(held["term"], held["positions"])}
    hit = np.zeros(int(starts[-1] + lengths[-1]) if len(starts) else 0, dtype=bool)
    of_doc: dict[int, set] = {}
    for window, items in windows:
        if not all(t in postings for t in window):
            continue
        begin = _exact(window, postings) if slop is None else _near(window, postings, slop)
        if not len(begin):
            continue
        for i in range(len(window) if slop is None else 1):
            hit[begin + i] = True
        for doc in np.unique(np.searchsorted(starts, begin, side="right") - 1).tolist():
            of_doc.setdefault(doc, set()).update(items)
    docs = sorted(of_doc)
    columns = {
        "id": [directory["ids"][d] for d in docs], "row": [directory["rows"][d] for d in docs],
        "hit": [np.flatnonzero(hit[starts[d]:starts[d] + lengths[d]]).tolist() for d in docs],
        "items": [sorted(of_doc[d]) for d in docs]}
    return pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in columns.items()})


def _hit_finder(windows: list, slop: int | None):
    def find(shard: pd.DataFrame) -> pd.DataFrame:
        return _hits(shard, windows, slop)

    return find


def phrase_hits(index: DataFrame, windows: DataFrame, slop: int | None = None,
                block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(id, row, hit, items): documents of the index that have a window, hit word numbers, items.

    With `slop`, proximity matches instead: all words of the window, in any order, within its length
    plus `slop` words of its rarest word; `hit` then has the places of that word. `slop` must leave
    the reach below the gap between documents.
    """
    spark = index.sparkSession
    if slop is not None and slop + WINDOW >= GAP:
        raise ValueError("slop too large for the gap between documents")
    windows = stage(windows, "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    kind = index.schema["ids"].dataType.elementType.simpleString()
    schema = f"id {kind}, row bigint, hit array<int>, items array<string>"
    found = None
    for block in range(blocks):
        mine = [(tuple(bytes(t) for t in r["terms"]), list(r["items"])) for r in windows.filter(
            F.pmod(F.xxhash64("terms"), F.lit(blocks)) == block).toLocalIterator()]
        # at most the words of one block of windows
        terms = spark.createDataFrame([(t,) for t in sorted({t for w, _ in mine for t in w})],
                                      "_term binary")
        held = index.join(F.broadcast(terms), F.col("term") == F.col("_term"), "left_semi")
        asked = held.select("shard", "term", "positions", "ids", "rows", "starts", "lengths").unionAll(
            index.filter(F.col("term").isNull()))
        here = asked.groupBy("shard").applyInPandas(_hit_finder(mine, slop), schema)
        found = here if found is None else found.unionAll(here)
    return (found.groupBy("id", "row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  width: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(_id, _row, n_words, hit, items): one row per input row.

    `hit` has the numbers of the words inside any occurrence of a window, `items` the names of the
    items with such windows. A null or empty text has no words and no hits; items without words have
    no windows. Rows that repeat an id are rows of their own. Other columns are not read; an empty
    table on either side gives no hits.
    """
    index = build_index(docs, id_col, text_col, shard_words)
    hits = phrase_hits(index, test_windows(benchmark, item_col, item_text, width)).select(
        F.col("id").alias("_h_id"), F.col("row").alias("_h_row"), "hit", "items")
    rows = index.filter(F.col("term").isNull()).select(
        F.explode(F.arrays_zip("ids", "rows", "lengths")).alias("d")).select(
        F.col("d.ids").alias("_id"), F.col("d.rows").alias("_row"),
        F.col("d.lengths").cast("bigint").alias("n_words"))
    none = F.array().cast("array<int>")
    return rows.join(hits, F.col("_id").eqNullSafe(F.col("_h_id"))
                     & (F.col("_row") == F.col("_h_row")), "left").select(
        "_id", "_row", "n_words", F.coalesce("hit", none).alias("hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """`docs` without those that have a window of the benchmark; all columns stay.

    A null or empty text has no window and stays, as does everything if the benchmark has no words. Rows
    that repeat id and text go or stay together; ids may be null; an empty table stays empty.
    """
    rows = contamination(docs, benchmark, id_col, text_col)
    return without_rows(docs, rows.filter(F.size("hit") > 0).select("_id", "_row"), id_col, text_col)
