"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers, so counts, sums and the centred scatter are exact however the rows are
dealt. The scatter (as many numbers as a vector has entries, squared) is factored with diagonal pivoting,
and plane rotations are applied to the columns of the triangular factor itself until all are orthogonal:
the squares of their norms are the eigenvalues, the columns of length one the components.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import pieces, stage
from ledgersift.operators.duplicates import distinct_rows
from ledgersift.operators.sizing import small_rows

SCALE = 256
COMPONENTS = 4
MAX_ENTRIES = 4096           # longest vector whose scatter is factored on the driver
BATCH_BYTES = 16 << 20
SWEEPS = 60
DIGITS = 10 ** 18            # exact totals travel as two decimals, above and below this
EXACT_DOUBLE, EXACT_LONG = 1 << 53, 1 << 62
LARGEST_DECIMAL = 10 ** 38 - 1


def whole_entries(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * entry) of each entry, taken in double precision."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))


def usable(vector: Column) -> Column:
    """Neither null nor empty, nor with null, NaN or infinite entries."""
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))

    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def _matrix(column: pa.Array, entries: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, entries)


def _largest(block: np.ndarray) -> int:
    return max(abs(int(block.max())), abs(int(block.min()))) if block.size else 0


def _column_sums(block: np.ndarray) -> np.ndarray:
    """Exact sums per column, as Python numbers."""
    if _largest(block) * len(block) >= EXACT_LONG:
        block = block.astype(object)
    return np.asarray(block.sum(axis=0)).astype(object)


def _products(block: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of columns, as Python numbers.

    Matrix products of doubles are exact while every partial sum is a whole number below 2^53; larger
    entries are multiplied as Python numbers.
    """
    size = _largest(block)
    total = np.zeros((block.shape[1],) * 2, dtype=object)
    if size ** 2 >= EXACT_DOUBLE:
        wide = block.astype(object)
        return total + wide.T.dot(wide)
    step = max(1, min(len(block), (EXACT_DOUBLE - 1) // max(1, size ** 2)))
    for at in range(0, len(block), step):
        part = block[at:at + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _exact_totals(rows: DataFrame, entries: int, numbers: Callable[[np.ndarray], np.ndarray]) -> dict:
    """{(i, j): total} of the arrays that `numbers` makes of blocks of rows (column `x`), summed exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in pieces(batches, BATCH_BYTES):
            if batch.num_rows:
                found = numbers(_matrix(batch.column(0), entries))
                total = found if total is None else total + found
        if total is None:
            return
        split = [divmod(int(v), DIGITS) for v in total.ravel()]
        i, j = np.divmod(np.arange(total.size), total.shape[-1])
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), pa.array([Decimal(h) for h, _ in split], kind),
             pa.array([Decimal(v) for _, v in split], kind)], ["i", "j", "high", "low"])

    sums = (rows.select("x").mapInArrow(run, "i bigint, j bigint, high decimal(38,0), low decimal(38,0)")
            .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")))
    found = small_rows(sums, "scatter", MAX_ENTRIES ** 2)
    return {(r["i"], r["j"]): int(r["high"]) * DIGITS + int(r["low"]) for r in found}


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L^T and as many columns as `a` has rank; the largest remaining diagonal is next.

    Rows stay in the order of `a`; taken in the order of the pivots, they are triangular.
    """
    left = np.diag(a).astype(float).copy()
    low = np.zeros_like(a, dtype=float)
    done = np.zeros(len(a), dtype=bool)
    least = len(a) * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(len(a)):
        p = int(np.argmax(np.where(done, -np.inf, left)))
        if left[p] <= least:
            return low[:, :k]
        column = (a[:, p] - low[:, :k] @ low[p, :k]) / math.sqrt(left[p])
        column[done] = 0.0
        column[p] = math.sqrt(left[p])
        low[:, k] = column
        left -= column ** 2
        done[p] = True
    return low


def one_sided_jacobi(low: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as rows) of L L^T by rotating pairs of columns of L until all are orthogonal."""
    cols = low.T.copy()
    eps = np.finfo(float).eps
    for _ in range(sweeps):
        still = True
        for i in range(len(cols) - 1):
            for j in range(i + 1, len(cols)):
                a, b, c = cols[i] @ cols[i], cols[j] @ cols[j], cols[i] @ cols[j]
                if abs(c) <= eps * math.sqrt(a * b):
                    continue
                still = False
                zeta = (b - a) / (2.0 * c)
                t = math.copysign(1.0, zeta) / (abs(zeta) + math.hypot(1.0, zeta))
                cos = 1.0 / math.hypot(1.0, t)
                cols[i], cols[j] = cos * (cols[i] - t * cols[j]), cos * (cols[j] + t * cols[i])
        if still:
            break
    norms = np.sqrt((cols ** 2).sum(axis=1))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, cols[order] / norms[order, None]


@dataclass
class Whitening:
    """What the fit list determines: count, sums, eigenvalues (divisor n) and components as rows."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray
    scale: int = SCALE

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: as longs where they fit, else as Python numbers."""
        sums = np.array(self.sums, dtype=object)
        if self.n * _largest(x) + max(map(abs, self.sums), default=0) >= EXACT_LONG:
            return self.n * x.astype(object) - sums
        return self.n * x - sums.astype(np.int64)

    def project(self, centred: np.ndarray, count: int) -> np.ndarray:
        """Whitened coordinates of centred rows on the first `count` components."""
        unit = (centred / self.n).astype(np.float64)
        return unit @ self.components[:count].T / np.sqrt(self.values[:count])


def _vectors(df: DataFrame, vector_col: str, scale: int, *more: Column) -> DataFrame:
    vector = F.col(vector_col)
    return df.filter(usable(vector)).select(*more, whole_entries(vector, scale).alias("x"))


def usual_length(df: DataFrame, vector_col: str) -> int:
    """The most frequent length of usable vectors; of equally frequent ones the greatest; 0 without any."""
    sizes = df.filter(usable(F.col(vector_col))).groupBy(F.size(vector_col).alias("d")).agg(
        F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return first["d"] if first else 0


def fit_whitening(df: DataFrame, vector_col: str = "embedding", scale: int = SCALE) -> tuple[Whitening, DataFrame]:
    """The whitening of the distinct vectors of `df`, and these vectors (column `x`), stored.

    Vectors of another length than the usual one are left out, as are those that `usable` refuses. An
    empty fit list, or one without spread, has no components; there are as many as the rank.
    """
    entries = usual_length(df, vector_col)
    if entries > MAX_ENTRIES:
        raise ValueError(f"vectors of {entries} entries; at most {MAX_ENTRIES} are factored")
    vectors = _vectors(df, vector_col, scale).filter(F.size("x") == entries)
    fit_list = stage(distinct_rows(vectors), "whitening-vectors")
    if not entries:
        return Whitening(0, [], 0.0, np.zeros(0), np.zeros((0, 0)), scale), fit_list.limit(0)
    totals = _exact_totals(fit_list, entries, lambda b: np.append(_column_sums(b), len(b))[None, :])
    n, sums = totals[0, entries], [totals[0, j] for j in range(entries)]
    middle = [round(s / n) for s in sums]
    shift = np.array(middle, dtype=np.int64)
    # centred on whole numbers before multiplying; what is left of the mean is taken off exactly
    products = _exact_totals(fit_list, entries, lambda b: _products(b - shift))
    off = [s - n * m for s, m in zip(sums, middle)]
    scatter = np.array([[(n * products[i, j] - off[i] * off[j]) / n for j in range(entries)]
                        for i in range(entries)])
    squares, components = one_sided_jacobi(pivoted_cholesky(scatter))
    return Whitening(n, sums, float(np.trace(scatter)) / n, squares / n, components, scale), fit_list


def identity_error(model: Whitening, fit_list: DataFrame, components: int = COMPONENTS) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    count = min(components, len(model.values))
    if not count:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            if batch.num_rows:
                w = model.project(model.centred(_matrix(batch.column(0), len(model.sums))), count)
                sums = np.vstack([w.T @ w, w.sum(axis=0)])
                i, j = np.divmod(np.arange(sums.size), count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i), pa.array(j), pa.array(sums.ravel())], ["i", "j", "v"])

    rows = small_rows(fit_list.select("x").mapInArrow(run, "i bigint, j bigint, v double")
                      .groupBy("i", "j").agg(F.sum("v").alias("v")), "whitened covariance", MAX_ENTRIES ** 2)
    found = np.zeros((count + 1, count))
    for r in rows:
        found[r["i"], r["j"]] = r["v"] / model.n
    covariance = found[:-1] - np.outer(found[-1], found[-1])
    return float(np.abs(covariance - np.eye(count)).max())


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """(id, deviation, whitened): one row per row of `df` whose vector can be used.

    `whitened` holds the coordinates on the first components, as many as asked for and as there are;
    `deviation` is the sum of (n x - S)^2 over the entries, null beyond 38 digits. Rows that repeat an
    id, and null ids, stay; other columns are not read. Where all vectors are equal, rows have no
    coordinates; an empty table gives no rows.
    """
    count = min(components, len(model.values))
    entries = len(model.sums)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            if not batch.num_rows:
                continue
            centred = model.centred(_matrix(batch.column(1), entries))
            if entries * _largest(centred) ** 2 >= EXACT_LONG:
                centred = centred.astype(object)
            squares = (centred ** 2).sum(axis=1)
            w = model.project(centred, count)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.array([Decimal(int(v)) if v <= LARGEST_DECIMAL else None for v in squares],
                          pa.decimal128(38, 0)),
                 pa.array(list(w), pa.list_(pa.float64()))], ["id", "deviation", "whitened"])

    rows = _vectors(df, vector_col, model.scale, F.col(id_col).alias("id")).filter(F.size("x") == entries)
    return rows.mapInArrow(run, f"id {kind}, deviation decimal(38,0), whitened array<double>")
