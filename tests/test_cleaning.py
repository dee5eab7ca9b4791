import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgersift.functions import calendar
from ledgersift.functions.features import add_interactions, boxcox
from ledgersift.operators import cleaning, profile
from ledgersift.schema import TXN
from ledgersift.sources import read_txn, read_txn_csv, write_report, write_stage


@pytest.fixture()
def labels(spark):
    return spark.createDataFrame([(None,), ("white",), ("family_a",)], "label string")


def test_null_label_has_three_meanings(labels):
    flags = {r["label"]: r["fraud"] for r in cleaning.flag_fraud(labels).collect()}
    assert flags == {None: True, "white": False, "family_a": True}
    majority, minority = cleaning.split_by_label(labels)
    assert majority.count() == 1 and minority.count() == 1
    assert {r["label"] for r in cleaning.encode_label(labels).collect()} == {None, 1, 0}
    assert sorted(r["label"] for r in cleaning.relabel_binary(labels).collect()) == [
        "black", "white", "white"]


def test_calendar_edges(spark):
    rows = spark.createDataFrame(
        [(2011, 1), (2011, 366), (2012, 366), (2016, 60), (None, 1), (2012, None)],
        "year int, day int")
    out = calendar.add_weekend_flag(calendar.add_day_of_week(rows.withColumn(
        "date", calendar.txn_date())))
    found = {(r["year"], r["day"]): (r["date"], r["day_of_week"], r["is_holiday"])
             for r in out.collect()}
    assert found[2011, 1] == (dt.date(2011, 1, 1), 7, 1)
    assert found[2011, 366] == (None, None, 0)
    assert found[2012, 366][0] == dt.date(2012, 12, 31)
    assert found[2016, 60][0] == dt.date(2016, 2, 29)
    assert found[None, 1][0] is None and found[2012, None][0] is None


def test_public_holidays_are_exact_days(spark):
    rows = spark.createDataFrame([(1,), (14,), (15,), (360,)], "day int")
    flags = {r["day"]: r["is_public_holiday"] for r in calendar.add_holiday_flag(rows).collect()}
    assert flags == {1: 1, 14: 0, 15: 1, 360: 1}


def test_product_is_widened(spark):
    rows = spark.createDataFrame([(2**31 - 1, 2**31 - 1)], "a int, b int")
    assert add_interactions(rows, [("a", "b")]).first()["a_b_interaction"] == (2**31 - 1) ** 2


def test_boxcox_values_rise_with_x(spark):
    rows = spark.range(1, 50).select(*[boxcox(F.col("id"), lam).alias(f"l{i}") for i, lam in
                                       enumerate([-1.0, 0.0, 0.5, 2.0])]).collect()
    for a, b in zip(rows, rows[1:]):
        assert all(x < y for x, y in zip(a, b))


def test_union_matches_columns_by_name(spark):
    a = spark.createDataFrame([(1, 10)], "x int, y int")
    b = spark.createDataFrame([(20, 2)], "y int, x int")
    assert sorted(tuple(r) for r in cleaning.union_rows(a, b).collect()) == [(1, 10), (2, 20)]


def test_csv_round_trip_and_bad_value(spark, txn, tmp_path):
    path = str(tmp_path / "csv")
    txn.select(F.monotonically_increasing_id().alias("_c0"), *txn.columns).write.option(
        "header", True).csv(path)
    back = read_txn_csv(spark, path)
    assert back.schema == TXN and back.exceptAll(txn).isEmpty() and back.count() == txn.count()
    bad = str(tmp_path / "bad")
    spark.createDataFrame([("0,A,2011,one,1,0.5,1,1,1,1,white",)], "value string").write.text(bad)
    with pytest.raises(Exception):
        spark.read.schema(read_txn_csv(spark, path).schema).csv(bad)
        read_txn_csv(spark, bad).collect()
        raise AssertionError("a bad value must stop the job")


def test_filter_reaches_the_parquet_scan(spark, txn, tmp_path, capsys):
    path = str(tmp_path / "txn")
    write_stage(txn, path)
    read_txn(spark, path).filter(F.col("label") == "white").select("income").explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(label,white)" in plan
    assert "ReadSchema: struct<income:bigint,label:string>" in plan


def test_row_id_tells_rows_apart(spark, txn, tmp_path):
    path = str(tmp_path / "txn")
    txn.repartition(3).write.parquet(path)
    rows = read_txn(spark, path, row_id=True)
    assert rows.select("row_id").distinct().count() == txn.count()


def test_stored_types_are_cast(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.sql("SELECT 'A' AS address, 2011L AS year, 3L AS day, 1L AS length, 0.5 AS weight, "
              "1L AS count, 0L AS looped, 2L AS neighbors, 5L AS income, 'white' AS label"
              ).write.parquet(path)
    assert read_txn(spark, path).schema == TXN


def test_report_is_one_file(spark, tmp_path):
    path = tmp_path / "report"
    write_report(spark.range(100).repartition(4), str(path))
    assert len(list(path.glob("part-*"))) == 1


def test_step_counts(spark):
    rows = spark.createDataFrame([(1, None), (1, 2)], "a int, b int")
    counts = {r["step"]: r["n"] for r in profile.step_counts(
        rows, cleaning.drop_nulls(rows)).collect()}
    assert counts == {"before": 2, "after": 1}
