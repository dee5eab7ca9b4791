import math
import os
import sys
from collections import Counter

from pyspark.sql import functions as F

from ledgersift.operators.cleaning import drop_duplicates
from ledgersift.operators.numbering import number_rows_dealt
from ledgersift.operators.oversample import random_oversample

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plans import executed, shuffled  # noqa: E402


def test_nulls_nan_and_zeros(spark):
    nan = float("nan")
    rows = [(1, "a", 0.0), (1, "a", -0.0), (None, "a", nan), (None, "a", nan), (None, None, None),
            (None, None, None), (2, None, 1.0), (None, "2", 1.0), (3, "x", 5.0)]
    got = drop_duplicates(spark.createDataFrame(rows, "k int, s string, x double").repartition(4))
    found = Counter((r.k, r.s, "nan" if r.x is not None and math.isnan(r.x) else r.x) for r in got.collect())
    assert found == Counter([(1, "a", 0.0), (None, "a", "nan"), (None, None, None), (2, None, 1.0),
                             (None, "2", 1.0), (3, "x", 5.0)])
    assert got.columns == ["k", "s", "x"] and drop_duplicates(got.limit(0)).count() == 0


def test_equal_hashes_of_unequal_rows(spark, monkeypatch):
    """All rows share a hash: they are still told apart."""
    monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(1).cast("bigint"))
    rows = spark.createDataFrame([(i % 5, i % 2) for i in range(40)], "a int, b int")
    assert Counter(map(tuple, drop_duplicates(rows).collect())) == Counter(
        {(i % 5, i % 2): 1 for i in range(40)})


def test_rows_without_a_copy_are_not_moved(spark):
    """One row in a hundred has a copy: far less is shuffled than for a plain distinct."""
    rows = spark.range(0, 40_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    table = rows.union(rows.filter("id % 100 = 0"))
    got, plain = drop_duplicates(table), table.distinct()
    assert len(got.collect()) == len(plain.collect()) == 40_000
    assert 0 < shuffled(got) < shuffled(plain) / 20


def test_dealt_numbers(spark):
    rows = [(i % 50, float(i % 3)) for i in range(1000)] + [(7, 7.0)] * 1500
    table = spark.createDataFrame(rows, "k int, x double")
    for bucket_rows in (10, 400, 100_000):
        got = [sorted(map(tuple, number_rows_dealt(t, len(rows), bucket_rows=bucket_rows).collect()))
               for t in (table, table.repartition(7))]
        assert got[0] == got[1]
        assert sorted(r[2] for r in got[0]) == list(range(len(rows)))
        assert Counter(r[:2] for r in got[0]) == Counter(rows)
    assert number_rows_dealt(table.limit(0), 0).count() == 0
    only = spark.createDataFrame([(float(i),) for i in range(300)], "x double")
    assert number_rows_dealt(only, 300, bucket_rows=10).select("row_no").distinct().count() == 300


def test_oversampling_sorts_no_range(spark):
    rows = spark.range(3000).select((F.col("id") % 10 == 0).alias("fraud"), F.col("id").alias("v"))
    out = random_oversample(rows, "fraud")
    found = out.collect()
    assert Counter(r.fraud for r in found) == {True: 2700, False: 2700}
    drawn = Counter(r.v for r in found if r.fraud)
    assert len(drawn) == 300 and max(drawn.values()) < 9 + 6 * 3    # a binomial draw of mean 9 per row
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text and any(k == "ShuffleExchangeExec" for k, _ in executed(out))
