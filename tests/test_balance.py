import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgersift.operators.neighbors import nearest_neighbors
from ledgersift.operators.numbering import number_rows
from ledgersift.operators.oversample import parent_pairs, random_oversample, smote


@pytest.fixture()
def ten_and_two(spark):
    rows = [(False, i, float(i)) for i in range(10)] + [(True, 100, 1.5), (True, 200, 2.5)]
    return spark.createDataFrame(rows, "fraud boolean, a int, b double")


def counts(df):
    return {r["fraud"]: r["count"] for r in df.groupBy("fraud").count().collect()}


def test_random_oversample_balances(ten_and_two):
    out = random_oversample(ten_and_two, "fraud")
    assert counts(out) == {False: 10, True: 10}
    assert set(map(tuple, out.collect())) == set(map(tuple, ten_and_two.collect()))


def test_random_oversample_does_not_depend_on_the_partitioning(spark, txn):
    rows = txn.select("income", "day", (F.col("label") != "white").alias("fraud"))
    order = ["income", "day"]
    small = random_oversample(rows, "fraud", order_by=order)
    large = random_oversample(rows.repartition(5), "fraud", order_by=order)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_three_classes_and_null(spark):
    rows = spark.createDataFrame([("a", 1)] * 6 + [("b", 2)] * 2 + [("c", 3)] + [(None, 4)],
                                 "k string, v int")
    out = {r["k"]: r["count"] for r in random_oversample(rows, "k").groupBy("k").count().collect()}
    assert out == {"a": 6, "b": 6, "c": 6, None: 1}


def test_smote_with_two_minority_rows(ten_and_two):
    """One neighbour each: every new row lies on the one segment; whole numbers stay whole."""
    out = smote(ten_and_two, ["a", "b"], "fraud")
    assert counts(out) == {False: 10, True: 10}
    assert out.schema["a"].dataType == ten_and_two.schema["a"].dataType
    for r in out.filter("fraud").collect():
        u = r["b"] - 1.5
        assert 0 <= u <= 1 and r["a"] == int(100 + u * 100 + 1e-9) or r["a"] in (100, 200)


def test_smote_refuses_a_single_row(spark):
    rows = spark.createDataFrame([(True, 1.0), (False, 1.0), (False, 2.0)], "fraud boolean, x double")
    with pytest.raises(ValueError, match="one row"):
        smote(rows, ["x"], "fraud")


def brute(points, k):
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k]


@pytest.mark.parametrize("kind", ["spread", "copies", "ties", "outliers"])
def test_neighbours_equal_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    n, k = 700, 5
    points = rng.normal(0, 1, (n, 3)) * [1000, 10, 1]
    if kind == "copies":       # a third of all rows are one row
        points[: n // 3] = points[0]
    elif kind == "ties":       # a third share the widest feature only
        points[: n // 3, 0] = 12.0
    elif kind == "outliers":
        points[:5] *= 1000
    rows = spark.createDataFrame([tuple(map(float, p)) for p in points],
                                 "x double, y double, z double").repartition(4)
    numbered = number_rows(rows, ["x", "y", "z"]).cache()
    at = {r["row_no"]: (r["x"], r["y"], r["z"]) for r in numbered.collect()}
    ordered = np.array([at[i] for i in range(n)])
    expected = brute(ordered, k)
    for block_rows in (64, 10_000):
        found = nearest_neighbors(numbered, ["x", "y", "z"], k, block_rows).collect()
        assert len(found) == n * k
        for r in found:
            assert r["near_no"] != r["row_no"]
            assert r["distance"] == pytest.approx(expected[r["row_no"], r["pick"]], abs=1e-9)
            direct = np.sqrt(((ordered[r["row_no"]] - ordered[r["near_no"]]) ** 2).sum())
            assert r["distance"] == pytest.approx(direct, abs=1e-9)


def test_busy_blocks_are_split(spark, monkeypatch):
    from ledgersift.operators import neighbors
    monkeypatch.setattr(neighbors, "VISITS", 10)
    monkeypatch.setattr(neighbors, "PAIRS", 50)
    rng = np.random.default_rng(6)
    points = rng.normal(0, 1, (400, 2))
    rows = spark.createDataFrame([tuple(map(float, p)) for p in points], "x double, y double")
    numbered = number_rows(rows, ["x", "y"]).cache()
    at = {r["row_no"]: (r["x"], r["y"]) for r in numbered.collect()}
    expected = brute(np.array([at[i] for i in range(400)]), 3)
    for r in nearest_neighbors(numbered, ["x", "y"], 3, 32).collect():
        assert r["distance"] == pytest.approx(expected[r["row_no"], r["pick"]], abs=1e-9)


def test_visited_blocks_grow_slower_than_blocks(spark, monkeypatch):
    """Eight features of equal spread: four times the rows, four times the blocks, far fewer visits."""
    from ledgersift.operators import neighbors
    seen = {}

    def counted(own, placed, features, k):
        found = visits(own, placed, features, k)
        rows, blocks = own.count(), placed.select("leaf", "piece").distinct().count()
        seen[rows] = (found.count() / rows, blocks)
        return found

    visits = neighbors._visits
    monkeypatch.setattr(neighbors, "_visits", counted)
    rng = np.random.default_rng(9)
    features = [f"f{i}" for i in range(8)]
    for n in (3000, 12_000):
        centres = rng.normal(0, 1, (60, 8))
        points = centres[rng.integers(0, 60, n)] + rng.normal(0, 0.05, (n, 8))
        rows = spark.createDataFrame([tuple(map(float, p)) for p in points], features)
        assert nearest_neighbors(number_rows(rows, features), features, 5, 64).count() == 5 * n
    (few, small), (more, large) = seen[3000], seen[12_000]
    assert large >= 3 * small and more < 2.5 * few and more < 0.05 * large


def test_parents_are_minority_rows(spark):
    rows = spark.createDataFrame([(float(i), float(i * i % 17)) for i in range(60)],
                                 "x double, y double")
    numbered = number_rows(rows, ["x", "y"]).cache()
    plain = {(r["x"], r["y"]) for r in numbered.collect()}
    for r in parent_pairs(numbered, ["x", "y"], 4, 16).collect():
        assert (r["x"], r["y"]) in plain and (r["near_x"], r["near_y"]) in plain


def test_tied_neighbours_do_not_depend_on_the_blocks(spark):
    rng = np.random.default_rng(8)
    points = rng.integers(0, 4, (400, 2)).astype(float)
    rows = spark.createDataFrame([tuple(map(float, p)) for p in points], "x double, y double")
    numbered = number_rows(rows, ["x", "y"]).cache()
    found = [sorted((r["row_no"], r["pick"], r["near_no"]) for r in nearest_neighbors(
        numbered, ["x", "y"], 5, block_rows).collect()) for block_rows in (32, 10_000)]
    assert found[0] == found[1]


def test_visited_rows_beyond_the_cap_on_leaves(spark, monkeypatch):
    """With 16 leaves at most, four times the points are four times the blocks, not four times the work."""
    from ledgersift.operators import neighbors
    seen = {}

    def counted(own, placed, features, k):
        found = visits(own, placed, features, k)
        sizes = placed.groupBy("leaf", "piece").agg(F.count(F.lit(1)).alias("n"))
        rows = found.join(sizes, ["leaf", "piece"]).agg(F.sum("n").alias("n")).first()["n"]
        seen[own.count()] = (rows / own.count(), sizes.count(), sizes.agg(F.max("n")).first()[0],
                             sizes.select("leaf").distinct().count())
        return found

    visits = neighbors._visits
    monkeypatch.setattr(neighbors, "_visits", counted)
    monkeypatch.setattr(neighbors, "SAMPLE", 256)
    monkeypatch.setattr(neighbors, "PLACED", 300)
    rng = np.random.default_rng(9)
    features = [f"f{i}" for i in range(4)]
    for n in (2000, 8000):
        centres = rng.normal(0, 1, (60, 4))
        points = centres[rng.integers(0, 60, n)] + rng.normal(0, 0.05, (n, 4))
        rows = spark.createDataFrame([tuple(map(float, p)) for p in points], features)
        numbered = number_rows(rows, features).cache()
        found = nearest_neighbors(numbered, features, 3, 32)
        assert found.count() == 3 * n
        if n == 2000:
            at = {r["row_no"]: tuple(r[f] for f in features) for r in numbered.collect()}
            expected = brute(np.array([at[i] for i in range(n)]), 3)
            for r in found.collect():
                assert r["distance"] == pytest.approx(expected[r["row_no"], r["pick"]], abs=1e-9)
    (few, small, _, leaves), (more, large, most, _) = seen[2000], seen[8000]
    assert leaves <= 16 and large >= 2.5 * small and most <= 128 and more < 2.2 * few


def test_cuts_below_a_frequent_top():
    """More than half of the points at the highest value: both sides of a cut still hold some."""
    from ledgersift.operators import neighbors
    points = np.array([[0.0], [1.0], [2.0]] + [[9.0]] * 20)
    feature, value = neighbors._cuts(points, 1)
    assert len(set(neighbors._leaf_of(points, feature, value))) == 2
