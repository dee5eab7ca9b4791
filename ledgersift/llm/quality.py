"""Quality grades by ordinal cumulative-link regression on hashed text.

One weight vector is shared by all grades, and ordered thresholds cut the score s of a text into
grades: P(grade <= k) = logistic(t_k - s). The features are the distinct words and symbol runs of a
text, hashed, with a few marks of repetition. Weights are fitted on a bounded sample of rated rows and
then score every row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import pieces, utf8
from ledgersift.llm.phrase_index import WORD_TABLE

BUCKETS = 1 << 18
SAMPLE_ROWS = 15_000    # rated rows used for the fit, at most
MIN_SHARE = 0.003       # a feature must occur in this share of the sample
RIDGE = 1e-3
STEPS = 150
RATE = 0.08
BATCH_BYTES = 32 << 20

# All word bytes and spaces become a space, so that runs of symbols are left.
SYMBOL_TABLE = bytes(32 if WORD_TABLE[b] != 32 or b < 33 else b for b in range(256))


def features(text: bytes) -> set[bytes]:
    """Distinct words and word beginnings, symbol runs and marks of repetition of one text."""
    words = text.translate(WORD_TABLE).split()
    found = set(words)
    spread = len(words) / len(found) if found else 0.0
    found.update([b"^" + w[:4] for w in found if len(w) > 4], [b"^" + w[:5] for w in found if len(w) > 5])
    for run in set(text.translate(SYMBOL_TABLE).split()):
        found.add(b"#" + run)
        if len(run) > 1 and run[-1] == run[-2]:
            found.add(b"##" + run[-1:])
    if words:
        again = sum(map(bytes.__eq__, words, words[1:]))
        found.add(b"##spread%d" % int(np.log2(spread) * 2))
        found.add(b"##again%d" % int(again * 10 / len(words)))
        found.add(b"##same%d" % again.bit_length())
    else:
        found.add(b"##none")
    return found


def bucket_ids(text: bytes, buckets: int) -> np.ndarray:
    return np.unique(np.fromiter((zlib.crc32(f) for f in features(text)), dtype=np.int64) % buckets)


@dataclass
class OrdinalModel:
    """Weights of the buckets that have one, and the thresholds between the grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, text: bytes) -> float:
        return float(self.weights[bucket_ids(text, len(self.weights))].sum())

    def tail(self, chances: Column, grade: int) -> Column:
        """P(grade or better) from the array of a text: 0 for a grade above all that were rated.

        Without any rated text the odds are even for every grade.
        """
        if grade < 1:
            return F.lit(1.0)
        if grade <= len(self.thresholds):
            return chances[grade - 1]
        return F.lit(0.0 if self.weights.any() or self.thresholds.any() else 0.5)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... as columns."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, grade_count: int,
                buckets: int = BUCKETS, min_share: float = MIN_SHARE, ridge: float = RIDGE,
                steps: int = STEPS, rate: float = RATE) -> OrdinalModel:
    """Fit by Adam on the full sample; thresholds stay ordered as they are sums of exponentials."""
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, dtype=np.int64)
    row_of = np.repeat(np.arange(len(rows)), sizes)
    seen = np.bincount(flat, minlength=buckets)
    used = np.flatnonzero(seen >= max(2, min_share * len(rows)))
    place = np.full(buckets, -1)
    place[used] = np.arange(len(used))
    column = place[flat]
    row_of, column = row_of[column >= 0], column[column >= 0]
    n, d, cuts = len(rows), len(used), grade_count - 1
    below = np.array([(np.sum(grades <= k) + 1) / (n + 2) for k in range(cuts)])
    start = np.log(below / (1 - below))
    gaps = np.log(np.maximum(np.diff(start), 1e-3))
    theta = np.concatenate([np.zeros(d), start[:1], gaps])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights = theta[:d]
        limits = theta[d] + np.concatenate([[0.0], np.cumsum(np.exp(theta[d + 1:]))])
        scores = np.bincount(row_of, weights[column], minlength=n)
        edges = np.concatenate([[-np.inf], limits, [np.inf]])
        up, down = _logistic(edges[grades + 1] - scores), _logistic(edges[grades] - scores)
        p = np.maximum(up - down, 1e-12)
        up_slope, down_slope = up * (1 - up), down * (1 - down)
        by_score = (up_slope - down_slope) / p / n        # of the negative log likelihood
        by_limit = np.zeros(cuts + 2)
        np.add.at(by_limit, grades + 1, -up_slope / p / n)
        np.add.at(by_limit, grades, down_slope / p / n)
        by_limit = by_limit[1:-1]
        gradient = np.concatenate([
            np.bincount(column, by_score[row_of], minlength=d) + ridge * weights,
            [by_limit.sum()],
            np.cumsum(by_limit[::-1])[::-1][1:] * np.exp(theta[d + 1:])])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient ** 2
        theta = theta - rate * (mean / (1 - 0.9 ** step)) / (
            np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(buckets, dtype=np.float32)
    weights[used] = theta[:d]
    return OrdinalModel(weights, theta[d] + np.concatenate([[0.0], np.cumsum(np.exp(theta[d + 1:]))]))


def fit_quality(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", grade_col: str = "grade", sample_rows: int = SAMPLE_ROWS,
                buckets: int = BUCKETS) -> OrdinalModel:
    """Fit on the texts of up to `sample_rows` ratings, those with the least hash of their id.

    `ratings` has (`id_col`, `grade_col`): whole numbers 0.. where more is better; null grades are left
    out, any other value is an error. Columns of `docs` and `ratings` may have any names. The sample is
    small enough to be sent to all tasks, so the texts are not shuffled; the fit runs in one task on hashed
    features, whose number the sample bounds. Without rated texts every text gets the same score and even
    odds.
    """
    grade = F.col(grade_col)
    whole = F.when((grade < 0) | (grade != F.floor(grade)), F.raise_error(F.concat(
        F.lit("a grade must be a whole number from 0 on, not "), grade.cast("string")))).otherwise(grade)
    sample = (ratings.filter(grade.isNotNull() & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("_rated"), whole.cast("int").alias("_grade"))
              .orderBy(F.xxhash64("_rated"), "_rated", "_grade").limit(sample_rows))
    texts = docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("text"))
    rated = texts.join(F.broadcast(sample), F.col("_id") == F.col("_rated")).select(
        F.col("_grade").alias("grade"), "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([bucket_ids(t.as_py(), buckets) for t in batch.column(1)],
                                           pa.list_(pa.int64()))], ["grade", "ids"])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        grades = group["grade"].to_numpy(dtype=np.int64)
        model = fit_ordinal(list(group["ids"]), grades, max(2, int(grades.max()) + 1), buckets)
        kept = np.flatnonzero(model.weights)
        return pd.DataFrame({"bucket": [kept], "weight": [model.weights[kept].astype(float)],
                             "threshold": [model.thresholds]})

    # the limit matters where ids repeat; it takes hashed rows, not texts
    rows = rated.mapInArrow(hashed, "grade int, ids array<bigint>").limit(sample_rows)
    found = rows.groupBy().applyInPandas(
        fit, "bucket array<bigint>, weight array<double>, threshold array<double>").collect()
    weights = np.zeros(buckets, dtype=np.float32)
    if not found:
        return OrdinalModel(weights, np.zeros(1))
    weights[np.array(found[0]["bucket"], dtype=np.int64)] = found[0]["weight"]
    return OrdinalModel(weights, np.array(found[0]["threshold"]))


def tail_probabilities(model: OrdinalModel, spark) -> object:
    """A column function: the text's P(grade >= 1), P(grade >= 2), ... as an array."""
    shared = spark.sparkContext.broadcast((model.weights, model.thresholds))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, thresholds = shared.value
        known = OrdinalModel(weights, thresholds)
        memory: dict[bytes, float] = {}

        def of(text: bytes) -> float:
            total, ids = 0.0, set()
            for f in features(text):
                if (w := memory.get(f)) is None:
                    b = zlib.crc32(f) % len(weights)
                    w = (b, float(weights[b]))
                    if len(memory) > 500_000:
                        memory.clear()
                    memory[f] = w
                if w[1] and w[0] not in ids:
                    ids.add(w[0])
                    total += w[1]
            return total

        for texts in batches:
            yield pd.Series(list(known.tails(np.array([of(t) for t in texts], dtype=float))))

    return F.pandas_udf(score, "array<double>")


def score_quality(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id",
                  text_col: str = "text", keep_grade: int = 2, least: float = 0.5) -> DataFrame:
    """(doc_id, expected_grade, p_tail, kept): one row per input row.

    `p_tail` is P(grade >= keep_grade), 0 for a grade above all rated ones, and a row is kept from `least`
    on. A null text scores like an
    empty one, rows that repeat are scored alike, and other columns are not read.
    """
    tails = tail_probabilities(model, docs.sparkSession)(utf8(F.col(text_col)))
    rows = docs.select(F.col(id_col).alias("doc_id"), tails.alias("_t"))
    tail = model.tail(F.col("_t"), keep_grade)
    return rows.select(
        "doc_id", F.aggregate("_t", F.lit(0.0), lambda a, x: a + x).alias("expected_grade"),
        tail.alias("p_tail"), (tail >= least).alias("kept"))


def keep_good(docs: DataFrame, model: OrdinalModel, text_col: str = "text", keep_grade: int = 2,
              least: float = 0.5) -> DataFrame:
    """The rows of `docs` with P(grade >= keep_grade) of at least `least`; all columns stay.

    A null text scores like an empty one; equal texts are kept or dropped alike, so rows that repeat stay
    together; ids may be null. An empty table stays empty.
    """
    tails: Column = tail_probabilities(model, docs.sparkSession)(utf8(F.col(text_col)))
    return docs.filter(model.tail(tails, keep_grade) >= least)


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 poor, 2 good; null where the quality is unknown."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(
        F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))
