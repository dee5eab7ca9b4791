"""Language identification by rank-order profiles of character n-grams.

Every language learns the order of its most frequent n-grams (one to three letters, words padded with a
space) over all texts labelled with it. A text's own n-grams are ranked in the same way, and its
out-of-place distance to a language is the sum of the differences of the ranks, with the length of a
profile for each n-gram that the language does not rank. The nearest language is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.llm.common import pieces
from ledgersift.operators.sizing import small_rows

TOP = 400                  # n-grams in a profile, of languages and of texts
MAX_LANGUAGES = 1000       # profiles go to every task; more languages than this are an error
BATCH_BYTES = 4 << 20
HELD_GRAMS = 2_000_000     # counts that a learning task holds before it hands them on
UNKNOWN = "und"
SPACE = 32
BITS = 21                  # of a code point; three fit in a signed 64-bit gram


class Letters:
    """Which code points are letters; each is looked up once."""

    def __init__(self):
        self.kind = np.zeros(0x110000, dtype=np.int8)

    def mask(self, codes: np.ndarray) -> np.ndarray:
        kind = self.kind[codes]
        if not kind.all():
            for c in np.unique(codes[kind == 0]):
                self.kind[c] = 2 if chr(c).isalpha() else 1
            kind = self.kind[codes]
        return kind == 2


def grams(text: str, letters: Letters) -> np.ndarray:
    """All n-grams of a text, repeats included, as numbers: three code points of 21 bits, padded with 0.

    Letters are lower-cased; all other characters part words. No n-gram reaches over two words.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where(letters.mask(codes), codes, SPACE).astype(np.int64)
    codes = np.concatenate([[SPACE], codes, [SPACE]])
    blank = codes == SPACE
    codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))]
    if len(codes) < 3:
        return np.zeros(0, dtype=np.int64)
    blank = codes == SPACE
    one = codes[~blank] << (2 * BITS)
    two = (codes[:-1] << (2 * BITS)) | (codes[1:] << BITS)
    three = ((codes[:-2] << (2 * BITS)) | (codes[1:-1] << BITS) | codes[2:])[~blank[1:-1]]
    return np.concatenate([one, two, three])


def ranked(found: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams in order; of equally frequent ones the lesser number first."""
    unique, n = np.unique(found, return_counts=True)
    return unique[np.argsort(-n, kind="stable")[:top]]


def _added(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in counts])
    unique, place = np.unique(keys, return_inverse=True)
    return unique, np.bincount(place, np.concatenate([n for _, n in counts])).astype(np.int64)


def _count_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters, held = Letters(), {}

    def rows():
        for lang, counts in held.items():
            keys, n = _added(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)],
                ["lang", "gram", "n"])

    for batch in pieces(batches, BATCH_BYTES):
        by_lang: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            by_lang.setdefault(lang, []).append(grams(text.as_py(), letters))
        for lang, found in by_lang.items():
            fresh = np.unique(np.concatenate(found), return_counts=True)
            held[lang] = [_added([*held.get(lang, []), fresh])]
        if sum(len(c[0][0]) for c in held.values()) > HELD_GRAMS:
            yield from rows()
            held.clear()
    yield from rows()


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   top: int = TOP) -> DataFrame:
    """(lang, gram, rank): the `top` most frequent n-grams of each language, ranks from 0.

    All rows with a text and a language are counted. Equal counts are ranked by the n-gram's number. A
    language whose texts hold no letter has no profile. Other columns are not read.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = (rows.mapInArrow(_count_by_language, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (counts.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < top)
            .select("lang", "gram", "rank"))


class Profiles:
    """Profiles of all languages as one table, sorted by n-gram."""

    def __init__(self, rows: list, top: int):
        self.top = top
        self.langs = sorted({r["lang"] for r in rows})
        number = {lang: i for i, lang in enumerate(self.langs)}
        order = sorted(rows, key=lambda r: (r["gram"], r["lang"]))
        self.gram = np.array([r["gram"] for r in order], dtype=np.int64)
        self.lang = np.array([number[r["lang"]] for r in order], dtype=np.int64)
        self.rank = np.array([r["rank"] for r in order], dtype=np.int64)

    def distances(self, order: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a text's ranked n-grams to each language."""
        low = np.searchsorted(self.gram, order, "left")
        many = np.searchsorted(self.gram, order, "right") - low
        place = np.repeat(np.arange(len(order)), many)
        entry = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
        near = self.top - np.minimum(np.abs(place - self.rank[entry]), self.top)
        return len(order) * self.top - np.bincount(
            self.lang[entry], near, minlength=len(self.langs)).astype(np.int64)

    def nearest(self, found: np.ndarray) -> tuple[str, float]:
        """The language and 1 minus its share of the greatest possible distance."""
        if not len(found) or not self.langs:
            return UNKNOWN, 0.0
        order = ranked(found, self.top)
        distance = self.distances(order)
        best = int(np.argmin(distance))      # of equally near languages the first by name
        return self.langs[best], 1.0 - float(distance[best]) / (len(order) * self.top)


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             top: int = TOP, max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """(id, lang_pred, score): one row per input row, read from the whole text alone.

    `score` is 1 for a text that ranks its n-grams as the language does and 0 for one that shares none.
    A null text, one without letters, and any text where nothing was learned get `und` and 0. Of equally
    near languages the first by name is taken. Rows that repeat an id are judged one by one, null ids
    stay; other columns are not read; an empty table gives no rows.

    `profiles` (`learn_profiles`) has `top` rows per language and goes to every task; more than
    `max_languages` languages raise an error.
    """
    known = Profiles(small_rows(profiles, "language profiles", top * max_languages), top)
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in pieces(batches, BATCH_BYTES):
            found = [known.nearest(grams(t.as_py() or "", letters)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        judge, f"id {kind}, lang_pred string, score double")
