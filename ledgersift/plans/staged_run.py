"""Process, engineer, report, train, report: each stage reads the files of the one before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgersift.functions.features import positive_score
from ledgersift.operators.cleaning import drop_nulls, encode_label
from ledgersift.operators.curves import confusion, pr_points, roc_points
from ledgersift.operators.distribution import (
    histogram_auto, kde, pair_density, scatter_pairs)
from ledgersift.operators.models import (
    assemble_features, compare_models, importances, predict, save_model)
from ledgersift.operators.profile import class_counts, correlation
from ledgersift.operators.sampling import FRACTION, downsample_majority, stratified_split
from ledgersift.plans.features import build_features
from ledgersift.plans.manifest import Manifest, source_digest
from ledgersift.schema import BOXCOX_COLUMNS, KEY_COLUMNS, NUMERIC, TRAINER_FEATURES
from ledgersift.sources import read_txn, write_report, write_stage


BOARD = "algorithm string, auc double, precision double, recall double, f1 double, accuracy double"


@dataclass(frozen=True)
class RunResult:
    best: str
    leaderboard: DataFrame
    folder: str


def process(txn: DataFrame, folder: str, fraction: float = FRACTION) -> DataFrame:
    """Drop rows with nulls and down-sample the majority.

    With a `row_id` column every row is drawn on its own, so a row that is repeated very often does
    not enter or leave the sample as a whole.
    """
    key = ["row_id"] if "row_id" in txn.columns else KEY_COLUMNS
    kept = downsample_majority(drop_nulls(txn), fraction, key).drop("row_id")
    return write_stage(kept, f"{folder}/processed")


def engineer(processed: DataFrame, folder: str) -> DataFrame:
    return write_stage(build_features(processed), f"{folder}/features")


def report_before(features: DataFrame, folder: str) -> None:
    """The data behind the pre-model charts, raw and Box-Cox columns alike."""
    both = BOXCOX_COLUMNS + [f"{c}_boxcox" for c in BOXCOX_COLUMNS]
    write_report(class_counts(features, "label"), f"{folder}/report/class_counts")
    write_stage(histogram_auto(features, both), f"{folder}/report/histograms")
    write_report(kde(features, both, cut=0.0), f"{folder}/report/densities")
    write_stage(pair_density(features, NUMERIC, "label"), f"{folder}/report/pairs")
    write_stage(scatter_pairs(features, ["length", "income", "weight"], ["count", "neighbors"],
                              "label"), f"{folder}/report/scatter")
    write_report(correlation(features, NUMERIC), f"{folder}/report/correlation")


def train(features: DataFrame, folder: str, names: list[str] | None = None,
          columns: list[str] = TRAINER_FEATURES) -> tuple[DataFrame, str]:
    """Fit and compare the classifiers; store the best one, its predictions and importances."""
    data = assemble_features(encode_label(features), columns)
    train_part, test_part = stratified_split(data)
    board, best, model = compare_models(train_part, test_part, names)
    write_report(board, f"{folder}/leaderboard")
    write_stage(predict(model, test_part), f"{folder}/predictions")
    write_report(importances(model, train_part, columns), f"{folder}/importances")
    save_model(model, columns, f"{folder}/model")
    return board, best


def report_after(spark: SparkSession, folder: str) -> None:
    """The data behind the post-model charts, from the stored predictions."""
    scored = positive_score(spark.read.parquet(f"{folder}/predictions"))
    write_stage(roc_points(scored), f"{folder}/report/roc")
    write_stage(pr_points(scored), f"{folder}/report/precision_recall")
    write_report(confusion(scored), f"{folder}/report/confusion")


def read_board(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("header", True).schema(BOARD).csv(f"{folder}/leaderboard")


def staged_run(spark: SparkSession, source: str, folder: str, fraction: float = FRACTION,
               names: list[str] | None = None) -> RunResult:
    """All five stages over the transactions stored at `source`, with results below `folder`.

    Each stage reads files and leaves a mark when its own are written. Called again with the same folder,
    a run goes on at the first stage that is not done for this source and these parameters; a new source
    or parameter does all stages behind it again.
    """
    manifest = Manifest(spark, folder)

    def processed() -> None:
        process(read_txn(spark, source, row_id=True), folder, fraction)

    def engineered() -> None:
        engineer(spark.read.parquet(f"{folder}/processed"), folder)

    def reported() -> None:
        report_before(spark.read.parquet(f"{folder}/features"), folder)

    def trained() -> str:
        return train(spark.read.parquet(f"{folder}/features"), folder, names)[1]

    at, _ = manifest.stage("process", source_digest(spark, source), {"fraction": fraction},
                           ["processed"], processed)
    features, _ = manifest.stage("engineer", at, {"columns": BOXCOX_COLUMNS}, ["features"], engineered)
    manifest.stage("report_before", features, {}, [f"report/{r}" for r in (
        "class_counts", "histograms", "densities", "pairs", "scatter", "correlation")], reported)
    model, best = manifest.stage(
        "train", features, {"names": names, "columns": TRAINER_FEATURES},
        ["leaderboard", "predictions", "importances", "model"], trained)
    manifest.stage("report_after", model, {}, [f"report/{r}" for r in (
        "roc", "precision_recall", "confusion")], lambda: report_after(spark, folder))
    return RunResult(best, read_board(spark, folder), folder)
