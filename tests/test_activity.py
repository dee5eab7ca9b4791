from collections import Counter

from pyspark.sql import functions as F

from ledgersift.operators.activity import add_num_addresses


def test_counts(spark):
    rows = [("a",), ("a",), ("b",), (None,), (None,), ("c",), ("a",)]
    got = add_num_addresses(spark.createDataFrame(rows, "address string")).collect()
    assert Counter((r.address, r.num_addresses) for r in got) == {
        ("a", 3): 3, ("b", 1): 1, ("c", 1): 1, (None, 0): 2}


def test_busy_address_is_split(spark):
    """A third of the rows on one address: the join deals them to several tasks."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k"}
    held = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 300_000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, "busy").otherwise(F.concat(F.lit("a"), F.col("id") % 40_000))
            .alias("address"), F.md5(F.col("id").cast("string")).alias("more"))
        joined = add_num_addresses(rows)
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p"), "num_addresses").agg(
            F.count(F.lit(1)).alias("n"), F.max("more")).filter("num_addresses = 100000").collect()]
        assert sum(sizes) == 100_000 and len(sizes) > 3 and max(sizes) < 50_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
