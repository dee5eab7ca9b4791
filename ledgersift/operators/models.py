"""Feature vectors, the six classifiers, comparison, importances, saving and loading."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes,
    RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ledgersift.functions.features import positive_score
from ledgersift.operators.curves import auc_roc, class_metrics
from ledgersift.schema import TRAINER_FEATURES

SEED = 1024

# Short name -> (name in the leaderboard, estimator).
ALGORITHMS = {
    "logistic": ("LogisticRegression", LogisticRegression),
    "tree": ("DecisionTreeClassifier", DecisionTreeClassifier),
    "forest": ("RandomForestClassifier", RandomForestClassifier),
    "bayes": ("NaiveBayes", NaiveBayes),
    "gbt": ("GBTClassifier", GBTClassifier),
    "svc": ("LinearSVC", LinearSVC),
}


def assembler(columns: list[str] = TRAINER_FEATURES) -> VectorAssembler:
    """A null or NaN feature is an error."""
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error")


def assemble_features(df: DataFrame, columns: list[str] = TRAINER_FEATURES) -> DataFrame:
    return assembler(columns).transform(df)


def estimator(name: str, **params) -> Estimator:
    """A classifier with default parameters; tree ensembles get a fixed seed."""
    kind = ALGORITHMS[name][1]
    if hasattr(kind, "seed"):
        params.setdefault("seed", SEED)
    return kind(featuresCol="features", labelCol="label", **params)


# Trees bin the rows once and store the binned points themselves; a stored copy of the rows beside
# those only doubles what a fit holds in memory.
STORES_OWN_INPUT = {"tree", "forest", "gbt"}


def fit(name: str, train: DataFrame, **params) -> Model:
    """Fit one classifier; the training rows are stored meanwhile, as every iteration reads them."""
    rows = train.select("features", "label")
    if name in STORES_OWN_INPUT:
        return estimator(name, **params).fit(rows)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator(name, **params).fit(rows)
    finally:
        rows.unpersist()


def predict(model: Model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def evaluate_auc(pred: DataFrame) -> float:
    """Exact area under ROC by the raw prediction of class 1."""
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC",
        numBins=0).evaluate(pred)


def compare_models(train: DataFrame, test: DataFrame, names: list[str] | None = None,
                   parallelism: int = 3) -> tuple[DataFrame, str, Model]:
    """Fit each algorithm; return (leaderboard, best name, best model).

    The leaderboard has one row per algorithm. The best has the highest AUC; on a tie the first.
    Train and test are stored for the length of the comparison because every fit reads them again.
    """
    names = names or list(ALGORITHMS)
    train = train.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    test = test.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)

    def run(name: str):
        model = estimator(name).fit(train)
        # one pass over the test rows; area and metrics read what it leaves
        pred = positive_score(model.transform(test)).select("label", "score", "prediction").persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            m, auc = class_metrics(pred).first(), auc_roc(pred).first()["auc"]
        finally:
            pred.unpersist()
        return model, (ALGORITHMS[name][0], auc, m["precision"], m["recall"], m["f1"],
                       m["accuracy"])

    try:
        with ThreadPool(max(1, min(parallelism, len(names)))) as pool:
            results = pool.map(inheritable_thread_target(train.sparkSession)(run), names)
    finally:
        train.unpersist()
        test.unpersist()
    best = max(range(len(names)), key=lambda i: (results[i][1][1], -i))
    board = train.sparkSession.createDataFrame(
        [row for _, row in results],
        "algorithm string, auc double, precision double, recall double, f1 double, "
        "accuracy double")
    return board, names[best], results[best][0]


def importances(model: Model, train: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, importance) for any of the six models, largest first.

    Trees report their own importances. Linear models report |coefficient| times the feature's
    standard deviation, naive Bayes the gap between the classes' log-probabilities.
    """
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "theta"):
        theta = model.theta.toArray()
        values = np.abs(theta[0] - theta[1])
    else:
        std = train.agg(*[F.stddev_samp(c).alias(f"s_{i}") for i, c in enumerate(columns)]).first()
        values = np.abs(model.coefficients.toArray()) * np.array([s or 0.0 for s in std])
    table = train.sparkSession.createDataFrame(
        [(c, float(v)) for c, v in zip(columns, values)], "feature string, importance double")
    return rank_importance(table)


def rank_importance(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature")


def save_model(model: Model, columns: list[str], path: str) -> None:
    """Save the classifier together with its assembler, so it can score plain columns."""
    PipelineModel([assembler(columns), model]).write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
