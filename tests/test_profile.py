import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgersift.operators import boxcox, distribution, outliers, profile, quantiles
from ledgersift.schema import HISTOGRAM_COLUMNS


def test_median_exact_and_approximate(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int")
    assert quantiles.exact_quantiles(rows, ["x"], [0.5]).first()["value"] == 2.5
    assert rows.agg(quantiles.approx_median("x")).first()[0] == 2
    assert rows.agg(quantiles.exact_median("x")).first()[0] == 2.5


@pytest.mark.parametrize("seed", range(3))
def test_searched_quantiles_are_exact(spark, seed):
    """Hot values, long tails and nulls; groups of very different size."""
    rng = random.Random(seed)
    data = []
    for i in range(20_000):
        hot = rng.random() < 0.35
        x = 7.0 if hot else rng.choice([rng.paretovariate(0.5), rng.gauss(0, 1), float(i % 5)])
        data.append((rng.random() < 0.02, x, None if rng.random() < 0.1 else rng.randint(0, 3)))
    rows = spark.createDataFrame(data, "g boolean, x double, k int").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.65, 0.75, 0.999, 1.0]
    coarse = quantiles.exact_quantiles(rows, ["x", "k"], probs, "g", sketch_k=8, margin=1e-4)
    searched = quantiles.exact_quantiles(rows, ["x", "k"], probs, "g")
    assert sorted(map(tuple, coarse.collect())) == sorted(map(tuple, searched.collect()))
    for r in searched.filter("column = 'x'").collect():
        xs = [x for g, x, _ in data if g == r["g"]]
        assert r["value"] == pytest.approx(np.percentile(xs, r["prob"] * 100), rel=1e-12)


def test_quantiles_with_nan_nulls_and_empty_groups(spark):
    nan = float("nan")
    data = ([("a", 1.0), ("a", nan), ("a", 3.0), ("a", None), ("b", None), ("c", nan), (None, 4.0),
             (None, 6.0)] + [("big", float(i % 3000)) for i in range(6000)] + [("big", nan)] * 3000)
    rows = spark.createDataFrame(data, "g string, x double").repartition(3)
    found = {(r["g"], r["prob"]): r["value"] for r in quantiles.exact_quantiles(
        rows, ["x"], [0.0, 0.5, 0.6, 1.0], "g").collect()}
    assert found["a", 0.5] == 3.0 and math.isnan(found["a", 1.0]) and found["a", 0.0] == 1.0
    assert found["b", 0.5] is None and math.isnan(found["c", 0.5]) and found[None, 0.5] == 5.0
    ordered = sorted(i % 3000 for i in range(6000))
    assert found["big", 0.5] == np.percentile(ordered + [9999] * 3000, 50) and len(found) == 20
    assert math.isnan(found["big", 1.0])


def test_quantiles_of_very_many_groups(spark):
    rows = spark.range(200_000).select((F.col("id") % 40_000).alias("g"), F.col("id").alias("x"))
    table = quantiles.exact_quantiles(rows, ["x"], [0.5], "g", sketch_k=8)
    assert table.count() == 40_000
    assert table.filter("value <> g + 80000").count() == 0


def test_class_stats_equals_direct(txn):
    rows = txn.withColumn("fraud", F.col("label") != "white")
    cols = ["income", "weight", "length"]
    searched = profile.class_stats(rows, "fraud", cols)
    direct = rows.groupBy("fraud").agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (
        ("mean", F.mean), ("std", F.stddev_samp))], *[F.median(c).alias(f"median_{c}") for c in cols])
    assert direct.columns == searched.columns
    for a, b in zip(direct.orderBy("fraud").collect(), searched.orderBy("fraud").collect()):
        assert tuple(a) == pytest.approx(tuple(b), rel=1e-12)
    approx = profile.class_stats(rows, "fraud", cols, median="approx").collect()
    assert {r["fraud"] for r in approx} == {True, False}


def test_approximate_median_rank(txn):
    n = txn.count()
    m = txn.agg(quantiles.approx_median("income").alias("m")).first()["m"]
    below = txn.filter(F.col("income") < m).count()
    upto = txn.filter(F.col("income") <= m).count()
    assert below <= n / 2 + n / 1000 and upto >= n / 2 - n / 1000


def test_histogram_edges(spark):
    rows = spark.createDataFrame([(0,), (5,), (10,)], "x int")
    bins = {r["bin"]: r["n"] for r in distribution.histogram(rows, ["x"], 5).collect()}
    assert bins == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1}


def test_histogram_leaves_out_nulls(spark):
    rows = spark.createDataFrame([(0,), (5,), (10,), (None,), (None,)], "x int")
    bins = {r["bin"]: r["n"] for r in distribution.histogram(rows, ["x"], 5).collect()}
    assert bins == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1}
    assert distribution.histogram_auto(rows, ["x"]).agg(F.sum("n")).first()[0] == 3


def test_histogram_counts_every_row(txn):
    counts = distribution.histogram(txn, HISTOGRAM_COLUMNS).groupBy("column").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("bins")).collect()
    assert {(r["n"], r["bins"]) for r in counts} == {(txn.count(), 30)}
    auto = distribution.histogram_auto(txn, ["income"]).agg(F.sum("n")).first()[0]
    assert auto == txn.count()


def test_constant_column(spark):
    rows = spark.createDataFrame([(5.0, float(i)) for i in range(10)], "c double, x double")
    table = {(r["col_a"], r["col_b"]): r["r"]
             for r in profile.correlation(rows, ["c", "x"]).collect()}
    assert math.isnan(table["c", "x"]) and math.isnan(table["c", "c"]) and table["x", "x"] == 1.0
    assert distribution.histogram(rows, ["c"], 4).agg(F.sum("n")).first()[0] == 10
    assert distribution.histogram_auto(rows, ["c"]).collect()[0]["n"] == 10
    assert distribution.kde(rows, ["c"]).count() == 0
    with pytest.raises(boxcox.BoxCoxError, match="c:"):
        boxcox.boxcox_lambdas(rows, ["x", "c"])


def test_correlation_refuses_or_skips_nulls(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 7.0), (5.0, 1.0)],
                                 "a double, b double")
    with pytest.raises(ValueError, match="b"):
        profile.correlation(rows, ["a", "b"])
    r = {(x["col_a"], x["col_b"]): x["r"]
         for x in profile.correlation(rows, ["a", "b"], invalid="skip").collect()}
    assert r["a", "b"] == pytest.approx(np.corrcoef([1, 3, 5], [2, 7, 1])[0, 1])


def test_correlation_over_pairwise_complete_rows(spark):
    rows = [(1.0, 2.0, None), (2.0, None, 1.0), (3.0, 7.0, 2.0), (5.0, 1.0, 9.0), (None, 4.0, 4.0)]
    table = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation(
        spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"], "pairwise").collect()}
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            both = [(r[i], r[j]) for r in rows if None not in (r[i], r[j])]
            assert table[x, y] == pytest.approx(np.corrcoef(*zip(*both))[0, 1])


def test_zscore_sample_and_population(spark):
    rows = spark.createDataFrame([(1.0,)] * 20 + [(100.0,)], "x double")
    values = np.array([1.0] * 20 + [100.0])
    for ddof in (0, 1):
        far = outliers.outliers(outliers.zscore(rows, "x", ddof), "x").collect()
        assert len(far) == 1
        assert far[0]["z_x"] == pytest.approx((100 - values.mean()) / values.std(ddof=ddof))
    same = spark.createDataFrame([(2.0,)] * 3, "x double")
    assert outliers.outliers(outliers.zscore(same, "x"), "x").count() == 0
    assert outliers.outlier_points(same, "x").filter("is_outlier").count() == 0


def test_kde_equals_direct_sum(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1, 300), rng.normal(6, 0.5, 200)])
    rows = spark.createDataFrame([(float(v),) for v in values], "x double")
    curve = distribution.kde(rows, ["x"], grid=50).orderBy("point").collect()
    bw = values.std(ddof=1) * len(values) ** -0.2
    for r in curve:
        direct = np.exp(-0.5 * ((r["x"] - values) / bw) ** 2).sum() / (
            len(values) * bw * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(direct, rel=1e-9, abs=1e-18)


def _llf(x, lam):
    y = np.asarray(x, float) + 1
    t = np.log(y) if lam == 0 else (y**lam - 1) / lam
    return (lam - 1) * np.log(y).sum() - len(y) / 2 * np.log(t.var())


def test_boxcox_lambda_is_the_best(spark):
    rng = np.random.default_rng(3)
    data = {"a": rng.lognormal(1, 0.7, 800), "b": rng.gamma(2, 3, 800),
            "c": (rng.beta(8, 1, 800) * 10) ** 0.25 * 40}
    rows = spark.createDataFrame(list(map(lambda t: tuple(map(float, t)), zip(*data.values()))),
                                 "a double, b double, c double")
    found = boxcox.boxcox_lambdas(rows, list(data))
    for c, x in data.items():
        near = [found[c] + d for d in np.linspace(-0.01, 0.01, 41)]
        assert _llf(x, found[c]) >= max(_llf(x, lam) for lam in near) - 1e-6
        wide = np.linspace(-3, 40, 500)
        assert _llf(x, found[c]) >= max(_llf(x, lam) for lam in wide) - 1e-6


def test_boxcox_refuses_values_at_or_below_minus_one(spark):
    rows = spark.createDataFrame([(-1.0,), (2.0,)], "x double")
    with pytest.raises(boxcox.BoxCoxError, match="x:"):
        boxcox.boxcox_fit(rows, ["x"])


def test_describe_categorical_tie(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "x string")
    assert tuple(profile.describe_categorical(rows, "x").first()) == (4, 2, "a", 2)


def test_small_table_refuses_a_large_one(spark):
    from ledgersift.operators.sizing import small_table
    with pytest.raises(ValueError, match="more than 5"):
        small_table(spark.range(6).toDF("id"), "ids", 5)


def test_median_approx_never_shuffles_rows_onto_its_few_group_keys(spark, folder):
    """Large tables get no broadcast by size; a join on (class, column) then puts whole groups in one task."""
    from ledgersift.checks.queries import QUERIES
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = QUERIES["median_approx"](spark, folder)
        plan = result._jdf.queryExecution().executedPlan().toString()
        rows = result.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert len(rows) == 6 and all(r.occurs and r.in_bounds for r in rows)
