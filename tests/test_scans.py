"""Passes over the table, compiled aggregates and error bounds of the statistics."""

import math
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgersift.operators import boxcox, distribution, profile, quantiles

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scans import counted  # noqa: E402


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(0, 30_000, 1, 4).select(
        (F.col("id") % 3 == 0).alias("g"), (F.rand(7) * 1000).alias("x"), F.randn(8).alias("y"),
        (F.col("id") % 7).cast("double").alias("k")).persist()


@pytest.mark.parametrize("by", [None, "g"])
def test_quantiles_read_twice(numbers, by):
    rows, seen = counted(numbers)
    got = quantiles.exact_quantiles(rows, ["x", "y", "k"], [0.25, 0.5, 0.75], by).collect()
    assert seen.value == 2 * 30_000
    for r in got:
        part = numbers.toPandas()
        part = part if by is None else part[part.g == r["g"]]
        assert r["value"] == pytest.approx(np.percentile(part[r["column"]], r["prob"] * 100), rel=1e-12)


def test_nan_shifts_the_bracket(spark):
    """With NaN in the group few values are kept beside the counts, as without."""
    rows = spark.range(50_000).select(
        F.when(F.col("id") % 4 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("x"))
    spots = [(0, 0, 0.5)]
    plain = rows.withColumn("_group", F.lit(0)).withColumnRenamed("x", "x_0")
    ladders = quantiles._ladders(plain, 1, quantiles.SKETCH_K)
    brackets = quantiles._brackets(ladders, ["x"], [0.5], quantiles.MARGIN)
    cells = quantiles._cells(plain, brackets, spots, False)
    assert 10 < cells.count() < 50_000 * 0.02
    found = quantiles.exact_quantiles(rows, ["x"], [0.5, 0.9]).orderBy("prob").collect()
    ordered = sorted(i for i in range(50_000) if i % 4)
    low = (50_000 - 1) // 2
    assert found[0]["value"] == (ordered[low] + ordered[low + 1]) / 2 and math.isnan(found[1]["value"])


def test_values_of_a_bracket_are_parted(spark, monkeypatch):
    """Few parts, many parts, infinite ends: the same values."""
    data = [(float(i % 997) ** 3,) for i in range(9_000)] + [(math.inf,)] * 5 + [(-math.inf,)] * 5
    rows = spark.createDataFrame(data, "x double").repartition(4)
    want = [float(np.percentile(np.array([x for x, in data]), p * 100, method="lower")) for p in (0.1, 0.5, 0.9)]
    for parts in (1, 7, 1024):
        monkeypatch.setattr(quantiles, "BUCKETS", parts)
        got = quantiles.exact_quantiles(rows, ["x"], [1 / 9009 * round(p * 9009) for p in (0.1, 0.5, 0.9)])
        assert [r["value"] for r in got.orderBy("prob").collect()] == pytest.approx(want, rel=0.02)
    ends = quantiles.exact_quantiles(rows, ["x"], [0.0, 1.0]).orderBy("prob").collect()
    assert [r["value"] for r in ends] == [-math.inf, math.inf]


def test_correlation_reads_twice_in_compiled_sums(numbers):
    rows, seen = counted(numbers)
    table = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation(rows, ["x", "y", "k"]).collect()}
    assert seen.value == 2 * 30_000
    pdf = numbers.toPandas()
    assert table["x", "k"] == pytest.approx(np.corrcoef(pdf.x, pdf.k)[0, 1], abs=1e-12)


def test_nine_columns_are_one_compiled_aggregate(spark):
    rows = spark.range(100).select(*[(F.col("id") * i % 17).cast("double").alias(f"c{i}") for i in range(9)])
    sums = [F.sum(F.col(f"c{i}") * F.col(f"c{j}")) for i in range(9) for j in range(i, 9)]
    sums += [F.sum(f"c{i}") for i in range(9)]
    assert len(sums) == 54 < profile.SUMS_AT_ONCE
    many = rows.agg(*[F.sum(F.col(f"c{k % 9}") + k).alias(f"s{k}") for k in range(profile.SUMS_AT_ONCE)])
    for table in (rows.agg(*sums), many):
        table.collect()
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "*(1) HashAggregate" in plan and "*(2) HashAggregate" in plan


def test_pairwise_correlation_with_many_sparse_columns(spark):
    """Several columns with nulls, more sums than one aggregate takes."""
    rng = np.random.default_rng(4)
    data = rng.normal(size=(400, 9)) + rng.normal(size=(400, 1)) + 50
    hole = rng.random((400, 9)) < np.linspace(0, 0.6, 9)
    rows = [tuple(None if h else float(v) for v, h in zip(*r)) for r in zip(data, hole)]
    names = [f"c{i}" for i in range(9)]
    table = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation(table, names, "pairwise").collect()}
    for i in range(9):
        for j in range(9):
            both = ~(hole[:, i] | hole[:, j])
            assert got[names[i], names[j]] == pytest.approx(
                np.corrcoef(data[both, i], data[both, j])[0, 1], abs=1e-10)


def _direct(points, values, bw):
    return np.array([np.exp(-0.5 * ((x - values) / bw) ** 2).sum() for x in points]) / (
        len(values) * bw * math.sqrt(2 * math.pi))


@pytest.mark.parametrize("shape", ["normal", "heavy", "steps"])
def test_kde_error_and_cells(spark, shape):
    """Within the stated bound, from two scans and no more rows than there are cells."""
    rng = np.random.default_rng(6)
    values = {"normal": rng.normal(size=20_000), "heavy": rng.standard_cauchy(20_000),
              "steps": rng.integers(0, 40, 20_000).astype(float)}[shape]
    table = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4).persist()
    rows, seen = counted(table)
    curve = distribution.kde(rows, ["x"], grid=120).orderBy("point").collect()
    assert seen.value == 2 * len(values)
    bw = values.std(ddof=1) * len(values) ** -0.2
    want = _direct(np.array([r["x"] for r in curve]), values, bw)
    bound = distribution.SERIES_ERROR / (bw * math.sqrt(2 * math.pi))
    assert distribution.SERIES_ERROR < 1e-15
    assert np.abs(np.array([r["density"] for r in curve]) - want).max() <= bound + 1e-13 * want.max()


def test_kde_leaves_out_columns_without_a_width(spark):
    nan = float("nan")
    table = spark.createDataFrame(
        [(1.0, 2.0, nan, None), (2.0, 2.0, 1.0, None), (4.0, 2.0, 2.0, 5.0)], "a double, b double, c double, d double")
    assert {r["column"] for r in distribution.kde(table, list("abcd")).collect()} == {"a"}
    assert distribution.kde(table.limit(0), ["a"]).count() == 0


def test_kde_by_null_class(spark):
    table = spark.createDataFrame([(None, 1.0), (None, 3.0), (True, 2.0), (True, 5.0)], "g boolean, x double")
    assert {r["g"] for r in distribution.kde(table, ["x"], by="g", grid=5).collect()} == {None, True}


def test_boxcox_reads_three_times(spark):
    rng = np.random.default_rng(3)
    data = {"a": rng.lognormal(1, 0.7, 5000), "b": rng.gamma(2, 3, 5000), "c": 1e9 * rng.lognormal(0, 0.1, 5000)}
    table = spark.createDataFrame(list(zip(*[map(float, v) for v in data.values()])),
                                  "a double, b double, c double").persist()
    rows, seen = counted(table)
    found = boxcox.boxcox_lambdas(rows, list(data))
    assert seen.value == 3 * 5000
    for c, x in data.items():
        y = np.log(x + 1)
        w = y - y.mean()

        def llf(lam):
            t = w if lam == 0 else np.expm1(lam * w) / lam
            return -math.log(t.var())

        grid = found[c] + np.linspace(-0.002, 0.002, 41)
        assert abs(grid[int(np.argmax([llf(g) for g in grid]))] - found[c]) <= 1.01e-4


def test_boxcox_series_equals_rows(spark):
    """The summary gives the likelihoods of the rows, near and far from the top."""
    rng = np.random.default_rng(5)
    table = spark.createDataFrame([(float(v),) for v in rng.lognormal(2, 1.5, 3000)], "x double")
    likelihood = boxcox._Likelihood(table, ["x"])
    lams = [-12.0, -3.0, -0.5, -1e-7, 0.0, 1e-4, 0.7, 2.0, 6.0, 12.0]
    near, exact = likelihood.near({"x": lams})["x"], likelihood.exact({"x": lams})["x"]
    assert near == pytest.approx(exact, rel=1e-9)


def test_boxcox_without_maximum(spark):
    """Beyond the reach of the series the rows are read; a likelihood that rises for ever is an error."""
    rng = np.random.default_rng(9)
    table = spark.createDataFrame([(float(v),) for v in 1e6 * (1 + 1e-3 * rng.beta(8, 1, 4000))], "x double")
    with pytest.raises(boxcox.BoxCoxError, match="no maximum"):
        boxcox.boxcox_lambdas(table, ["x"])


def test_pair_density_equals_direct_counts(spark):
    rng = np.random.default_rng(8)
    rows = [(float(a), int(b), None if c > 2 else float(c), cls) for a, b, c, cls in zip(
        rng.normal(size=700), rng.integers(0, 5, 700), rng.normal(size=700),
        rng.choice(["u", "v", "n"], 700))]
    rows = [(a, b, c, None if cls == "n" else cls) for a, b, c, cls in rows]
    table, seen = counted(spark.createDataFrame(rows, "a double, b int, c double, cls string").repartition(3))
    got = {(r["x_name"], r["y_name"], r["bin_x"], r["bin_y"], r["cls"]): r["n"]
           for r in distribution.pair_density(table, ["a", "b", "c"], "cls", 6).collect()}
    assert seen.value == 2 * 700

    def bins(column):
        known = [v for v in column if v is not None]
        lo, width = min(known), (max(known) - min(known)) / 6
        return [None if v is None else min(int((v - lo) // width), 5) for v in column]

    place = {n: bins([r[i] for r in rows]) for i, n in enumerate("abc")}
    want = {}
    for i, x in enumerate("abc"):
        for y in "abc"[i:]:
            for p, q, r in zip(place[x], place[y], rows):
                if p is not None and q is not None:
                    key = (x, y, p, q, r[3])
                    want[key] = want.get(key, 0) + 1
    assert got == want
