"""One query per operator, each over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift import schema as S
from ledgersift.functions import calendar
from ledgersift.functions.features import add_interactions, boxcox_apply, vector_to_columns
from ledgersift.operators import (
    activity, boxcox, cleaning, curves, distribution, models, outliers, oversample, profile,
    quantiles, sampling)
from ledgersift.operators.sizing import long_values
from ledgersift.plans.features import build_features
from ledgersift.plans.staged_run import staged_run
from ledgersift.session import work_folder
from ledgersift.sources import (
    read_requests, read_txn, read_txn_csv, write_report, write_stage)
from ledgersift.sources.lineitem_view import (
    SEPARABLE_FEATURES, dirty_view, score_view, separable_view, txn_view)
from ledgersift.streaming.scoring import (
    read_request_stream, read_scored, rejected_path, score, score_stream)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Lambdas used where a query needs Box-Cox columns but is not about fitting them.
LAMBDAS = {"length": 0.5, "income": 0.25, "weight": -0.5, "count": 0.0, "neighbors": 0.75}
PROFILE_GRID = [-1.0, -0.5, 0.0, 0.5, 1.0, 1.5]
RAW_AND_BOXCOX = S.BOXCOX_COLUMNS + [f"{c}_boxcox" for c in S.BOXCOX_COLUMNS]
REQUEST_ID = ["address", "year", "day", "income"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.flag_fraud(txn_view(spark, d))


# --- scans and sinks ---------------------------------------------------------------------------

@query
def scan_parquet(spark, d):
    path = work_folder(spark, "txn")
    txn_view(spark, d).write.parquet(path)
    return read_txn(spark, path)


@query
def scan_csv(spark, d):
    path = work_folder(spark, "txn-csv")
    indexed = txn_view(spark, d).select(
        F.monotonically_increasing_id().alias("_c0"), *S.TXN.fieldNames())
    indexed.write.option("header", True).csv(path)
    return read_txn_csv(spark, path)


@query
def sink_parquet(spark, d):
    return write_stage(cleaning.drop_nulls(dirty_view(spark, d)), work_folder(spark, "processed"))


@query
def sink_csv(spark, d):
    path = work_folder(spark, "report")
    write_report(profile.group_count(txn_view(spark, d), "year", "label").orderBy("year", "label"),
                 path)
    return spark.read.option("header", True).schema("year int, label string, n bigint").csv(path)


@query
def schema_report(spark, d):
    return profile.schema_report(dirty_view(spark, d))


# --- projections, filters, cleaning ------------------------------------------------------------

@query
def project_columns(spark, d):
    return txn_view(spark, d).select("length", "weight", "income")


@query
def drop_columns(spark, d):
    return cleaning.eda_table(dirty_view(spark, d))


@query
def drop_nulls(spark, d):
    return cleaning.drop_nulls(dirty_view(spark, d))


@query
def drop_duplicates(spark, d):
    return cleaning.drop_duplicates(dirty_view(spark, d))


@query
def filter_label(spark, d):
    majority, minority = cleaning.split_by_label(dirty_view(spark, d))
    return cleaning.union_rows(majority.withColumn("side", F.lit("majority")),
                               minority.withColumn("side", F.lit("minority")))


@query
def filter_fraud_trimmed(spark, d):
    rows = cleaning.suspicious(cleaning.flag_fraud(dirty_view(spark, d)), 100)
    return rows.select("length", "weight", "income")


@query
def flag_fraud(spark, d):
    return cleaning.flag_fraud(dirty_view(spark, d))


@query
def relabel_binary(spark, d):
    dirty = dirty_view(spark, d)
    whole = cleaning.relabel_binary(dirty).withColumn("spelling", F.lit("whole table"))
    minority = cleaning.relabel_minority(cleaning.split_by_label(dirty)[1])
    return cleaning.union_rows(whole, minority.withColumn("spelling", F.lit("minority")))


@query
def encode_label(spark, d):
    return cleaning.encode_label(dirty_view(spark, d))


# --- calendar and scalar functions -------------------------------------------------------------

@query
def txn_date(spark, d):
    return txn_view(spark, d).select("address", "year", "day",
                                     calendar.txn_date().alias("txn_date"))


@query
def day_of_week(spark, d):
    return calendar.add_day_of_week(txn_view(spark, d))


@query
def month_of_year(spark, d):
    return calendar.add_month(txn_view(spark, d))


@query
def weekend_flag(spark, d):
    return calendar.add_weekend_flag(calendar.add_day_of_week(txn_view(spark, d)))


@query
def public_holiday_flag(spark, d):
    return calendar.add_holiday_flag(txn_view(spark, d))


@query
def interaction_features(spark, d):
    rows = add_interactions(txn_view(spark, d)).select(
        *REQUEST_ID, "length_weight_interaction", "income_count_interaction")
    return _round(rows, 6, "length_weight_interaction")


@query
def boxcox_apply_columns(spark, d):
    names = [f"{c}_boxcox" for c in LAMBDAS]
    rows = boxcox_apply(txn_view(spark, d), LAMBDAS).select(*REQUEST_ID, *names)
    return _round(rows, 6, *names)


# --- aggregates and profiles -------------------------------------------------------------------

@query
def row_counts(spark, d):
    dirty = dirty_view(spark, d)
    return profile.step_counts(dirty, cleaning.drop_nulls(dirty))


@query
def null_counts(spark, d):
    return profile.null_counts(dirty_view(spark, d))


@query
def describe_table(spark, d):
    table = profile.describe(dirty_view(spark, d), quartiles=True)
    return _round(table, 4, "mean", "std", "min", "max", "q1", "median", "q3")


@query
def group_count_year(spark, d):
    return profile.group_count(txn_view(spark, d), "year").orderBy("year")


@query
def group_count_year_fraud(spark, d):
    return profile.group_count(cleaning.suspicious(_flagged(spark, d)), "year").orderBy("year")


@query
def group_count_day(spark, d):
    return profile.group_count(txn_view(spark, d), "day").orderBy("day").limit(10)


@query
def class_counts(spark, d):
    return profile.class_counts(cleaning.flag_fraud(dirty_view(spark, d)))


@query
def group_means(spark, d):
    return _round(profile.group_means(_flagged(spark, d), "fraud", ["income", "count"]), 4,
                  "mean_income", "mean_count")


@query
def fraud_stats(spark, d):
    stats = profile.class_stats(_flagged(spark, d), "fraud", S.STATS_COLUMNS)
    return _round(stats, 4, *[c for c in stats.columns if c != "fraud"])


@query
def median_approx(spark, d):
    """Per class and column: whether the median is one of the values and within 0.1 % of the rank."""
    rows = long_values(_flagged(spark, d), S.STATS_COLUMNS, ["fraud"])
    found = rows.groupBy("fraud", "column").agg(
        quantiles.approx_median("x").alias("m"), F.count(F.lit(1)).alias("n"))
    at = F.col("x").cast("double")
    # one row per class and column: a shuffled join on these few keys would put whole groups in one task
    counts = rows.join(F.broadcast(found), ["fraud", "column"]).groupBy("fraud", "column", "n").agg(
        F.sum((at < F.col("m")).cast("bigint")).alias("below"),
        F.sum((at == F.col("m")).cast("bigint")).alias("same"))
    half, slack = F.col("n") / 2, F.col("n") / 1000 + 1
    return counts.select("fraud", "column", (F.col("same") > 0).alias("occurs"),
                         ((F.col("below") <= half + slack)
                          & (F.col("below") + F.col("same") >= half - slack)).alias("in_bounds"))


@query
def median_exact(spark, d):
    table = quantiles.exact_quantiles(_flagged(spark, d), S.STATS_COLUMNS, [0.5], "fraud")
    return _round(table.drop("prob"), 6, "value")


@query
def global_moments(spark, d):
    return _round(profile.moments(txn_view(spark, d), "income"), 4, "mean", "std")


@query
def correlation_matrix(spark, d):
    return _round(profile.correlation(_flagged(spark, d), [*S.NUMERIC, "fraud"]), 6, "r")


@query
def correlation_pairwise(spark, d):
    """Over the rows with both values, on a table with nulls."""
    return _round(profile.correlation(dirty_view(spark, d), S.NUMERIC, "pairwise"), 6, "r")


@query
def histogram_fixed(spark, d):
    return _round(distribution.histogram(txn_view(spark, d), S.HISTOGRAM_COLUMNS), 6,
                  "bin_low", "bin_high")


@query
def histogram_fraud(spark, d):
    rows = cleaning.suspicious(_flagged(spark, d))
    return _round(distribution.histogram(rows, S.HISTOGRAM_COLUMNS), 6, "bin_low", "bin_high")


@query
def histogram_auto(spark, d):
    rows = boxcox_apply(txn_view(spark, d), dict.fromkeys(S.BOXCOX_COLUMNS, 0.0))
    return _round(distribution.histogram_auto(rows, RAW_AND_BOXCOX), 6, "bin_low", "bin_high")


@query
def kde_curve(spark, d):
    rows = boxcox_apply(txn_view(spark, d), dict.fromkeys(S.BOXCOX_COLUMNS, 0.0))
    curve = _round(distribution.kde(rows, RAW_AND_BOXCOX, cut=0.0), 4, "x")
    fine = F.when(F.col("column") == "income", F.round("density", 14)).otherwise(F.round("density", 9))
    return curve.withColumn("density", fine)


@query
def kde_by_class(spark, d):
    curve = distribution.kde(_flagged(spark, d), ["length", "weight", "income"], by="fraud")
    fine = F.when(F.col("column") == "income", F.round("density", 14)).otherwise(F.round("density", 10))
    return _round(curve, 4, "x").withColumn("density", fine)


@query
def boxplot_stats(spark, d):
    rows, columns = _flagged(spark, d), ["length", "weight", "income"]
    whole = distribution.boxplot_stats(rows, columns).withColumn("scope", F.lit("all"))
    trimmed = distribution.boxplot_stats(cleaning.suspicious(rows, 100), columns)
    both = whole.unionByName(trimmed.withColumn("scope", F.lit("suspicious")))
    return _round(both, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


def _fraud_calendar(spark, d):
    rows = txn_view(spark, d).transform(calendar.add_day_of_week).transform(calendar.add_month)
    return cleaning.suspicious(cleaning.flag_fraud(calendar.add_holiday_flag(rows)))


@query
def fraud_by_month(spark, d):
    return profile.fraud_frequency(_fraud_calendar(spark, d), "month", 1, 12)


@query
def fraud_by_holiday(spark, d):
    return profile.fraud_frequency(_fraud_calendar(spark, d), "is_public_holiday", 0, 1)


@query
def fraud_by_day(spark, d):
    days = profile.fraud_frequency(_fraud_calendar(spark, d), "day", 1, 365)
    return calendar.add_holiday_flag(days)


@query
def fraud_by_weekday(spark, d):
    return profile.fraud_frequency(_fraud_calendar(spark, d), "day_of_week", 1, 7)


@query
def scatter_sample(spark, d):
    kept = sampling.downsample_majority(txn_view(spark, d))
    return distribution.scatter_pairs(kept, ["length", "income", "weight"],
                                      ["count", "neighbors"], "label")


@query
def pair_density(spark, d):
    rows = cleaning.relabel_binary(txn_view(spark, d))
    return distribution.pair_density(rows, S.NUMERIC, "label")


@query
def boxcox_fit(spark, d):
    return _round(boxcox.boxcox_fit(txn_view(spark, d), S.BOXCOX_COLUMNS), 3, "lambda")


@query
def boxcox_profile(spark, d):
    return _round(boxcox.boxcox_profile(txn_view(spark, d), S.BOXCOX_COLUMNS, PROFILE_GRID), 3,
                  "llf")


@query
def describe_categorical(spark, d):
    balanced = oversample.random_oversample(_flagged(spark, d), "fraud")
    return profile.describe_categorical(balanced, "fraud")


# --- window, order, sets -----------------------------------------------------------------------

@query
def address_activity(spark, d):
    return activity.add_num_addresses(txn_view(spark, d))


@query
def order_by(spark, d):
    return profile.group_count(txn_view(spark, d), "year", "label").orderBy(
        "year", F.desc("n"), "label")


@query
def limit_rows(spark, d):
    return cleaning.head(txn_view(spark, d), 10)


@query
def union_all(spark, d):
    majority, minority = cleaning.split_by_label(txn_view(spark, d))
    turned = minority.select(*reversed(minority.columns))
    return cleaning.union_rows(majority, turned)


@query
def distinct_values(spark, d):
    return cleaning.distinct(cleaning.suspicious(_flagged(spark, d)), "year")


# --- sampling, balancing, splitting ------------------------------------------------------------

@query
def bernoulli_sample(spark, d):
    return sampling.sample(txn_view(spark, d), 0.8)


@query
def downsample_majority(spark, d):
    return sampling.downsample_majority(dirty_view(spark, d))


@query
def stratified_split(spark, d):
    return sampling.split_column(cleaning.encode_label(dirty_view(spark, d)))


@query
def random_oversample(spark, d):
    return oversample.random_oversample(cleaning.eda_table(txn_view(spark, d)), "fraud",
                                        order_by=[*S.NUMERIC])


@query
def smote_oversample(spark, d):
    made = oversample.smote(cleaning.eda_table(txn_view(spark, d)), S.NUMERIC, "fraud")
    return _round(made, 6, "weight")


# --- outliers ----------------------------------------------------------------------------------

def _outliers(spark, d, ddof: int) -> DataFrame:
    """Outliers of income and of a product with a longer tail."""
    rows, out = add_interactions(txn_view(spark, d), [("income", "count")]), None
    for c in ["income", "income_count_interaction"]:
        far = outliers.outliers(outliers.zscore(rows, c, ddof), c).select(
            *S.TXN.fieldNames(), F.lit(c).alias("measure"), F.round(f"z_{c}", 6).alias("z"))
        out = far if out is None else out.unionByName(far)
    return out


@query
def zscore_outliers(spark, d):
    return _outliers(spark, d, ddof=1)


@query
def zscore_outliers_pop(spark, d):
    return _outliers(spark, d, ddof=0)


@query
def outlier_scatter(spark, d):
    return outliers.outlier_points(txn_view(spark, d), "income")


# --- models ------------------------------------------------------------------------------------

def _features(spark, d):
    rows = cleaning.relabel_binary(cleaning.drop_nulls(txn_view(spark, d)))
    return build_features(write_stage(rows, work_folder(spark, "processed")), LAMBDAS)


def _train_test(spark, d):
    return sampling.stratified_split(
        models.assemble_features(separable_view(spark, d), SEPARABLE_FEATURES))


def _predicted(pred):
    return pred.select(*REQUEST_ID, "label", F.col("prediction").cast("int").alias("prediction"))


def _fit_query(name: str) -> Query:
    def run(spark, d):
        train, test = _train_test(spark, d)
        return _predicted(models.predict(models.fit(name, train), test))
    return run


for _key, _name in [("fit_logistic", "logistic"), ("fit_decision_tree", "tree"),
                    ("fit_random_forest", "forest"), ("fit_naive_bayes", "bayes"),
                    ("fit_gbt", "gbt"), ("fit_linear_svc", "svc")]:
    QUERIES[_key] = _fit_query(_name)


@query
def assemble_features(spark, d):
    names = [f"v{i}" for i in range(len(S.NOTEBOOK_FEATURES))]
    vectors = models.assemble_features(_features(spark, d), S.NOTEBOOK_FEATURES)
    flat = vector_to_columns(vectors.select("features"), "features", names).select(*names)
    return _round(flat, 6, *names)


@query
def vector_element(spark, d):
    names = [f"v_{c}" for c in S.NUMERIC]
    vectors = models.assemble_features(txn_view(spark, d), S.NUMERIC)
    return vector_to_columns(vectors, "features", names).select("address", *names)


@query
def auc_roc(spark, d):
    return _round(curves.auc_roc(score_view(spark, d)), 9, "auc")


@query
def weighted_metrics(spark, d):
    return _round(curves.class_metrics(score_view(spark, d)), 9,
                  "precision", "recall", "f1", "accuracy")


@query
def model_leaderboard(spark, d):
    board = models.compare_models(*_train_test(spark, d))[0]
    return _round(board, 9, "auc", "precision", "recall", "f1", "accuracy")


@query
def model_choice(spark, d):
    """A label that two features give only together, and nine times in ten: trees see it, lines do not."""
    even, late = F.col("count") % 2 == 0, F.col("day") > 183
    label = (even != late) != (F.col("income") % 10 == 0)
    rows = txn_view(spark, d).withColumns({
        "label": label.cast("int"), "even": even.cast("double"), "late": late.cast("double")})
    parts = sampling.stratified_split(
        models.assemble_features(rows, ["even", "late", "neighbors"]), key=REQUEST_ID[:3] + ["income"])
    board, best, _ = models.compare_models(*parts, names=["logistic", "tree", "svc"])
    return board.select("algorithm", F.when(F.col("auc") > 0.75, F.round("auc", 1)).alias("auc"),
                        (F.col("algorithm") == models.ALGORITHMS[best][0]).alias("chosen"))


@query
def roc_curve(spark, d):
    return _round(curves.roc_points(score_view(spark, d)), 9, "fpr", "tpr")


@query
def pr_curve(spark, d):
    return _round(curves.pr_points(score_view(spark, d)), 9, "precision", "recall")


@query
def confusion_matrix(spark, d):
    return curves.confusion(score_view(spark, d))


@query
def feature_importance(spark, d):
    """Whether each feature weighs more than the one that says nothing about the label."""
    train, _ = _train_test(spark, d)
    table = models.importances(models.fit("forest", train), train, SEPARABLE_FEATURES)
    noise = table.filter("feature = 'count'").select(F.col("importance").alias("noise"))
    return table.join(F.broadcast(noise)).select(
        "feature", (F.col("importance") > F.col("noise") + 0.1).alias("informative"))


@query
def rank_importance(spark, d):
    """Mean of each number column as its importance, stored as a report, read and ranked."""
    means = txn_view(spark, d).agg(*[F.round(F.mean(c), 6).alias(c) for c in S.NUMERIC])
    table = means.unpivot([], S.NUMERIC, "feature", "importance")
    path = work_folder(spark, "importances")
    write_report(table, path)
    stored = spark.read.option("header", True).schema("feature string, importance double").csv(path)
    ranked = models.rank_importance(stored).collect()
    return spark.createDataFrame([(i + 1, r["feature"], r["importance"]) for i, r in enumerate(ranked)],
                                 "place int, feature string, importance double")


@query
def test_predictions(spark, d):
    train, test = _train_test(spark, d)
    pred = models.predict(models.fit("tree", train), test)
    return _predicted(write_stage(pred, work_folder(spark, "predictions")))


def _stored_model(spark, d):
    train, _ = _train_test(spark, d)
    path = work_folder(spark, "model")
    models.save_model(models.fit("tree", train), SEPARABLE_FEATURES, path)
    return models.load_model(path)


def _requests(spark, d) -> tuple[str, T.StructType]:
    """All records as JSON lines."""
    records = separable_view(spark, d).select(
        *dict.fromkeys([*REQUEST_ID, "label", *SEPARABLE_FEATURES]))
    path = work_folder(spark, "requests")
    records.write.json(path)
    return path, records.schema


@query
def model_roundtrip(spark, d):
    return _predicted(score(_stored_model(spark, d), separable_view(spark, d)))


@query
def batch_scoring(spark, d):
    path, schema = _requests(spark, d)
    return _predicted(score(_stored_model(spark, d), read_requests(spark, path, schema)))


@query
def stream_scoring(spark, d):
    path, schema = _requests(spark, d)
    out = work_folder(spark, "scored")
    stream = score_stream(_stored_model(spark, d), read_request_stream(spark, path, schema), out,
                          work_folder(spark, "stream"))
    stream.awaitTermination()
    return _predicted(read_scored(spark, out))


@query
def stream_rejects(spark, d):
    """The requests as a stream in which some lines are cut off and some lack a feature: all that is refused."""
    records = separable_view(spark, d).select(
        *dict.fromkeys([*REQUEST_ID, "label", *SEPARABLE_FEATURES]))
    broken, lacking = F.col("income") % 71 == 0, F.col("income") % 73 == 0
    whole = records.withColumn("signal_b", F.when(~lacking, F.col("signal_b")))
    line = F.to_json(F.struct(*[F.col(c) for c in whole.columns]))
    path, out = work_folder(spark, "requests"), work_folder(spark, "scored")
    whole.select(F.when(broken, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(path)
    score_stream(_stored_model(spark, d), read_request_stream(spark, path, records.schema), out,
                 work_folder(spark, "stream")).awaitTermination()
    refused = spark.read.parquet(rejected_path(out))
    kept = read_scored(spark, out).agg(F.lit("scored").alias("reason"), F.count(F.lit(1)).alias("n"))
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).unionByName(kept)


# --- compositions ------------------------------------------------------------------------------

@query
def feature_table(spark, d):
    rows = _features(spark, d)
    return _round(rows, 6, "length_weight_interaction", *[f"{c}_boxcox" for c in LAMBDAS])


@query
def run_stages(spark, d):
    """The whole run on transactions whose class follows from one feature, which trees must find."""
    source = work_folder(spark, "source")
    family = F.when(F.col("looped") > 0, "family_a").otherwise(S.MAJORITY)
    txn_view(spark, d).withColumn("label", family).write.parquet(source)
    board = staged_run(spark, source, work_folder(spark, "run")).leaderboard
    tree = F.col("algorithm").isin("DecisionTreeClassifier", "GBTClassifier")
    return board.select("algorithm", F.when(tree, F.round("auc", 6)).alias("tree_auc"))


QUERIES["boxcox_apply"] = QUERIES.pop("boxcox_apply_columns")
