import math
from fractions import Fraction

import numpy as np
import pytest

from ledgersift.llm.common import read_table
from ledgersift.llm.queries import QUERIES
from ledgersift.llm.whitening import (
    fit_whitening, identity_error, one_sided_jacobi, pivoted_cholesky, whiten)

SCHEMA = "vec_id bigint, embedding array<double>, x int, id string, i int, deviation int, _row_hash int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, None, None, 0, 0) for r in rows], SCHEMA).repartition(3)


def brute(rows, count=4, scale=256):
    """(id, deviation, whitened up to sign) with exact sums and the covariance of the distinct vectors."""
    def good(v):
        return bool(v) and all(c is not None and math.isfinite(c) for c in v)

    x = [(k, tuple(math.floor(scale * c) for c in v)) for k, v in rows if good(v)]
    fit = sorted({v for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = [Fraction(s, n) for s in sums]
    centred = [[Fraction(c) - m for c, m in zip(v, mean)] for v in fit]
    cov = [[float(sum(r[i] * r[j] for r in centred) / n) for j in range(len(sums))] for i in range(len(sums))]
    values, vectors = np.linalg.eigh(np.array(cov))
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    rank = int((values > 1e-9 * values[0]).sum()) if values[0] > 0 else 0
    out = []
    for k, v in x:
        unit = np.array([float(c - m) for c, m in zip(v, mean)])
        out.append((k, sum((n * c - s) ** 2 for c, s in zip(v, sums)),
                    [abs(float(unit @ vectors[:, j]) / math.sqrt(values[j])) for j in range(min(count, rank))]))
    return n, values, np.trace(np.array(cov)), out


def compare(spark, rows):
    df = table(spark, rows)
    model, fit_list = fit_whitening(df)
    n, values, trace, want = brute(rows)
    assert model.n == n == fit_list.count()
    assert np.allclose(model.values, values[:len(model.values)], rtol=1e-9, atol=1e-12)
    assert model.trace == pytest.approx(trace, rel=1e-12)
    got = [(r.id, int(r.deviation), r.whitened) for r in whiten(df, model).collect()]
    assert sorted((k, d) for k, d, _ in got) == sorted((k, d) for k, d, _ in want)
    for (_, _, a), (_, _, b) in zip(sorted(got, key=repr_key), sorted(want, key=repr_key)):
        assert np.allclose(np.abs(a), b, rtol=1e-7, atol=1e-9)
    assert identity_error(model, fit_list) < 1e-9
    return model


def repr_key(row):
    return (row[0], row[1], [round(abs(v), 5) for v in row[2]])


def test_factor_and_rotations():
    rng = np.random.default_rng(1)
    for rank in (1, 3, 8):
        half = rng.normal(size=(8, rank)) * np.logspace(0, -3, rank)
        a = half @ half.T
        low = pivoted_cholesky(a)
        assert low.shape == (8, rank) and np.allclose(low @ low.T, a, atol=1e-12)
        values, parts = one_sided_jacobi(low)
        assert np.allclose(values, np.sort(np.linalg.eigvalsh(a))[::-1][:rank], rtol=1e-10)
        assert np.allclose(parts @ parts.T, np.eye(rank), atol=1e-10)
    assert pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_against_brute_force(spark):
    rng = np.random.default_rng(7)
    mix = rng.normal(size=(6, 6))
    rows = [(int(i), [float(c) for c in rng.normal(size=6) @ mix + 3]) for i in range(200)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]           # a hot vector counts once
    assert compare(spark, rows).components.shape == (6, 6)


def test_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(20)]
    rows += [(1, rows[1][1]), (2, rows[3][1])]                      # repeated rows and ids
    odd = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, math.nan, 2.0]),
           (54, [math.inf, 0.0, 0.0]), (55, [1.0, 2.0])]
    df = table(spark, rows + odd + [(None, [1.0, 2.0, 3.0])])
    model, _ = fit_whitening(df)
    got = whiten(df, model).collect()
    assert sorted(repr(r.id) for r in got) == sorted(repr(k) for k, _ in [*rows, (None, 0)])
    compare(spark, rows + odd[:-1])
    empty = df.limit(0)
    model, fit_list = fit_whitening(empty)
    assert (model.n, identity_error(model, fit_list), whiten(empty, model).count()) == (0, 0.0, 0)
    same = table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    model, fit_list = fit_whitening(same)
    assert (model.n, len(model.values), identity_error(model, fit_list)) == (1, 0, 0.0)
    assert [(int(r.deviation), r.whitened) for r in whiten(same, model).collect()] == [(0, [])] * 2


@pytest.mark.parametrize("size", [1e7, 1e13])
def test_entries_beyond_doubles_stay_exact(spark, size):
    rng = np.random.default_rng(3)
    compare(spark, [(i, [float(c) for c in rng.normal(size=3) * size]) for i in range(30)])


def test_largest_entries(spark):
    df = table(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])])
    model, fit_list = fit_whitening(df)
    assert len(whiten(df, model).collect()) == model.n == 3 and identity_error(model, fit_list) < 1e-4


def test_query(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, folder, "embeddings").collect()]
    n, values, trace, want = brute(rows)
    want = {(k, j + 1): (d, w) for k, d, ws in want for j, w in enumerate(ws)}
    got = QUERIES["op12_jacobi_whitening"](spark, folder).collect()
    assert len(got) == len(want) == 4 * len(rows)
    for r in got:
        d, w = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, d) and abs(abs(r.whitened) - w) < 1e-8
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
        assert r.identity_error < 1e-9
