"""ROC and precision-recall curves, area under ROC, confusion table and class metrics.

Curves need running counts over all scores in order. Equal scores are counted first and the counts
stored, so predictions are read once. A window without partitions would put all scores into one task;
instead the distinct scores are cut into ranges, running counts are taken within each range, and each
range adds the totals of those above it.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.operators.stored import stored


class OneClassError(ValueError):
    """A curve needs rows of both classes."""


class UnknownRowError(ValueError):
    """Rows that have no score or belong to neither class."""


def score_counts(pred: DataFrame, label: str = "label", score: str = "score",
                 invalid: str = "error") -> DataFrame:
    """(score, pos, neg) per distinct score, stored. NaN is one score, above all others.

    A row with a null score, or a label that is neither 0 nor 1, is an error; with `invalid="skip"` such
    rows are left out.
    """
    known = F.col(score).isNotNull() & F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    counts = stored(pred.groupBy(F.when(known, F.col(score).cast("double")).alias("score")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
        F.sum((F.col(label) == 0).cast("bigint")).alias("neg"),
        F.count(F.lit(1)).alias("n")), "scores")
    if invalid != "skip":
        row = counts.filter(F.col("score").isNull()).first()
        if row:
            raise UnknownRowError(
                f"{row['n']} rows without a {score} or with another {label} than 0 and 1")
    return counts.filter(F.col("score").isNotNull()).select("score", "pos", "neg")


def _totals(counts: DataFrame) -> tuple[int, int]:
    r = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    pos, neg = r["pos"] or 0, r["neg"] or 0
    if not pos or not neg:
        raise OneClassError(f"need both classes, got {pos} positive and {neg} negative rows")
    return pos, neg


def _range_ends(counts: DataFrame, ranges: int) -> list[float]:
    """Sketched scores that cut the distinct scores into about equal ranges."""
    k = min(65_535, max(800, 4 * ranges))
    sketch = (counts.groupBy(F.pmod(F.spark_partition_id(), F.lit(64)).alias("slice"))
              .agg(F.kll_sketch_agg_double(F.when(~F.isnan("score"), F.col("score")), k).alias("sketch"))
              .agg(F.kll_merge_agg_double("sketch", k).alias("sketch")))
    at = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    ends = sketch.select(F.kll_sketch_get_quantile_double("sketch", at)).first()[0] if counts.filter(
        ~F.isnan("score")).limit(1).count() else []
    return sorted({e for e in ends if math.isfinite(e)})


def running_counts(counts: DataFrame, ranges: int | None = None) -> DataFrame:
    """(score, pos, neg, tp, fp) from `score_counts`; tp and fp count this score and all above.

    By default there are as many ranges as shuffle partitions.
    """
    spark = counts.sparkSession
    ranges = max(2, ranges or int(spark.conf.get("spark.sql.shuffle.partitions")))
    # NaN gets a range of its own behind the last one, which is the highest
    located = Bucketizer(splits=[-math.inf, *(_range_ends(counts, ranges) or [0.0]), math.inf],
                         inputCol="score", outputCol="range", handleInvalid="keep").transform(counts)
    above = (Window.partitionBy("range").orderBy(F.desc("score"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = located.withColumns({"tp": F.sum("pos").over(above), "fp": F.sum("neg").over(above)})
    higher = (Window.partitionBy(F.lit(0)).orderBy(F.desc("range"))
              .rowsBetween(Window.unboundedPreceding, -1))  # one row per range
    before = located.groupBy("range").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).select(
        "range", F.coalesce(F.sum("pos").over(higher), F.lit(0)).alias("tp_before"),
        F.coalesce(F.sum("neg").over(higher), F.lit(0)).alias("fp_before"))
    return within.join(before, "range").select(
        "score", "pos", "neg", (F.col("tp") + F.col("tp_before")).alias("tp"),
        (F.col("fp") + F.col("fp_before")).alias("fp"))


def roc_points(pred: DataFrame, label: str = "label", score: str = "score",
               ranges: int | None = None, invalid: str = "error") -> DataFrame:
    """(threshold, fpr, tpr): one point per distinct score, and (0, 0) at threshold infinity."""
    counts = score_counts(pred, label, score, invalid)
    pos, neg = _totals(counts)
    points = running_counts(counts, ranges).select(
        F.col("score").alias("threshold"), (F.col("fp") / F.lit(neg)).alias("fpr"),
        (F.col("tp") / F.lit(pos)).alias("tpr"))
    start = pred.sparkSession.createDataFrame(
        [(math.inf, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(points)


def pr_points(pred: DataFrame, label: str = "label", score: str = "score",
              ranges: int | None = None, invalid: str = "error") -> DataFrame:
    """(threshold, precision, recall): one point per distinct score, and (1, 0) without one."""
    counts = score_counts(pred, label, score, invalid)
    pos, _ = _totals(counts)
    points = running_counts(counts, ranges).select(
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.lit(pos)).alias("recall"))
    end = pred.sparkSession.createDataFrame(
        [(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)


def auc_roc(pred: DataFrame, label: str = "label", score: str = "score",
            ranges: int | None = None, invalid: str = "error") -> DataFrame:
    """(auc): the share of (positive, negative) pairs ranked rightly, ties counting half."""
    counts = score_counts(pred, label, score, invalid)
    pos, neg = _totals(counts)
    higher = F.col("tp") - F.col("pos")
    area = F.sum(F.col("neg") * (higher + F.col("pos") / 2)) / F.lit(float(pos) * float(neg))
    return running_counts(counts, ranges).agg(area.alias("auc"))


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction",
              classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """(label, prediction, n) for every pair of classes, zero where there are no rows.

    A label or prediction outside `classes` is an error, so no row is left out of the counts.
    """
    counts = pred.groupBy(F.col(label).cast("int").alias("label"),
                          F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    def checked(column: str):
        value = F.col(column)
        return F.when(value.isin(*classes), value).otherwise(F.raise_error(F.concat(
            F.lit(f"{column} outside {classes}: "), F.coalesce(value.cast("string"), F.lit("null"))))
            .cast("int")).alias(column)

    known = counts.select(checked("label"), checked("prediction"), "n")
    domain = pred.sparkSession.createDataFrame(
        [(a, p) for a in classes for p in classes], "label int, prediction int")
    return known.join(F.broadcast(domain), ["label", "prediction"], "right").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def class_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                  classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """One row: precision, recall and F1 weighted by class size, and accuracy.

    All four come from the confusion table, so predictions are read once.
    """
    table = confusion(pred, label, prediction, classes)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sums = table.agg(F.sum("n").alias("rows"), F.sum(hit).alias("hits"), *[
        F.sum(F.when(test, F.col("n")).otherwise(0)).alias(f"{name}_{c}")
        for c in classes for name, test in (
            ("actual", F.col("label") == c), ("said", F.col("prediction") == c),
            ("right", (F.col("label") == c) & (F.col("prediction") == c)))])
    precision = recall = f1 = F.lit(0.0)
    for c in classes:
        right, said, actual = (F.col(f"{n}_{c}").cast("double") for n in ("right", "said", "actual"))
        p = F.coalesce(F.try_divide(right, said), F.lit(0.0))
        r = F.coalesce(F.try_divide(right, actual), F.lit(0.0))
        share = F.try_divide(actual, F.col("rows"))
        precision, recall = precision + share * p, recall + share * r
        f1 = f1 + share * F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return sums.select(
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        F.try_divide(F.col("hits"), F.col("rows")).alias("accuracy"))
