import pytest
from pyspark.sql import functions as F

from ledgersift.functions.hashing import hash_below, hash_fraction
from ledgersift.operators import activity, cleaning, numbering, sampling
from ledgersift.plans.features import build_features
from ledgersift.checks.queries import LAMBDAS


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("fraction", [0.0, 0.015, 0.5, 1.0])
def test_hex_comparison_equals_fraction(txn, fraction):
    parts = [F.col("address"), F.col("income")]
    odd = txn.filter(hash_below(parts, 7, fraction) != (hash_fraction(parts, 7) < fraction))
    assert odd.count() == 0


def test_sample_does_not_depend_on_partitions(txn):
    for cut in (lambda d: sampling.sample(d, 0.3), sampling.downsample_majority):
        assert rows_of(cut(txn.repartition(1))) == rows_of(cut(txn.repartition(7)))


def test_sample_size(txn):
    n = txn.count()
    assert abs(sampling.sample(txn, 0.8).count() - 0.8 * n) < 5 * (n * 0.16) ** 0.5


def test_downsample_keeps_every_minority_row_and_drops_null_labels(spark, folder):
    from ledgersift.sources.lineitem_view import dirty_view
    dirty = dirty_view(spark, folder)
    kept = sampling.downsample_majority(dirty)
    minority = dirty.filter("label <> 'white'").count()
    assert kept.filter("label = 'black'").count() == minority
    assert kept.filter("label IS NULL").count() == 0
    assert sampling.downsample_majority(dirty, 1.0).count() == dirty.filter(
        "label IS NOT NULL").count()


def test_downsample_scans_once(spark, folder, capsys):
    from ledgersift.sources.lineitem_view import txn_view
    sampling.downsample_majority(txn_view(spark, folder)).explain()
    assert capsys.readouterr().out.count("FileScan") == 1


@pytest.mark.parametrize("method", ["hash", "random"])
def test_split_is_whole_and_disjoint(txn, method):
    coded = cleaning.encode_label(txn)
    train, test = sampling.stratified_split(coded, method=method)
    assert rows_of(train.unionByName(test)) == rows_of(coded)
    for label in (0, 1):
        n = coded.filter(F.col("label") == label).count()
        share = train.filter(F.col("label") == label).count() / n
        assert abs(share - 0.8) < 5 * (0.16 / n) ** 0.5


def test_split_leaves_out_null_target(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (0, "c")], "label int, k string")
    train, test = sampling.stratified_split(rows, key=["k"])
    assert train.count() + test.count() == 2


def test_hot_address_counts_the_same_on_every_route(spark):
    data = ([("hot", i) for i in range(400)] + [(f"a{i % 150}", i) for i in range(600)]
            + [(None, i) for i in range(50)])
    rows = spark.createDataFrame(data, "address string, v int").repartition(4)
    expected = {}
    for a, _ in data:
        expected[a] = expected.get(a, 0) + (a is not None)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (threshold, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            out = activity.add_num_addresses(rows).collect()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert len(out) == len(data)
        assert {r["address"]: r["num_addresses"] for r in out} == expected


def test_address_counts_take_two_scans(spark, txn, tmp_path):
    path = str(tmp_path / "txn")
    txn.write.parquet(path)
    out = activity.add_num_addresses(spark.read.parquet(path))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 2


def test_row_numbers_follow_the_order(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 101).alias("a"), "id").repartition(5)
    small = rows_of(numbering.number_rows(rows, ["a", "id"]))
    large = rows_of(numbering.number_rows(rows.repartition(2), ["a", "id"]))
    assert small == large
    assert [r[2] for r in sorted(large)] == list(range(1000))


def test_row_numbers_with_many_copies(spark):
    rows = spark.range(900).select(F.lit(1).alias("a")).unionByName(
        spark.range(100).select(F.lit(0).alias("a"))).repartition(6)
    out = numbering.number_rows(rows, ["a"])
    numbers = {r["row_no"]: r["a"] for r in out.collect()}
    assert sorted(numbers) == list(range(1000))
    assert all(numbers[i] == 0 for i in range(100))


def test_feature_table_columns(spark, txn):
    processed = sampling.downsample_majority(txn)
    out = build_features(processed, LAMBDAS)
    assert out.columns[10:] == [
        "num_addresses", "day_of_week", "is_holiday", "length_weight_interaction",
        "income_count_interaction", "length_boxcox", "income_boxcox", "weight_boxcox",
        "count_boxcox", "neighbors_boxcox"]
    assert out.count() == processed.count()


def test_no_python_in_plans(spark, txn, capsys):
    from ledgersift.operators import distribution, profile
    flagged = cleaning.flag_fraud(txn)
    for df in (build_features(txn, LAMBDAS), distribution.histogram(txn, ["income"]),
               distribution.kde(flagged, ["weight"], by="fraud"),
               profile.class_stats(flagged, "fraud", ["income"])):
        df.explain()
        plan = capsys.readouterr().out
        assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan
