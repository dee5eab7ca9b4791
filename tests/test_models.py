import numpy as np
import shutil

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from ledgersift.functions.features import positive_score
from ledgersift.operators import curves, models
from ledgersift.plans import staged_run as run_plan
from ledgersift.plans.manifest import Manifest
from ledgersift.plans.staged_run import staged_run
from ledgersift.sources import read_requests, write_stage
from ledgersift.streaming.scoring import (
    read_request_stream, read_scored, rejected_path, score, score_stream, split_records)

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(0)
    one = [(1, float(a), float(b)) for a, b in zip(rng.poisson(30, 100), rng.poisson(3, 100))]
    zero = [(0, float(a), float(b)) for a, b in zip(rng.poisson(3, 100), rng.poisson(30, 100))]
    rows = spark.createDataFrame(one + zero, "label int, a double, b double")
    return models.assemble_features(rows, COLUMNS).cache()


def test_every_model_parts_two_clusters(separable):
    board, best, _ = models.compare_models(separable, separable)
    rows = board.collect()
    assert [r["algorithm"] for r in rows] == [name for name, _ in models.ALGORITHMS.values()]
    for r in rows:
        assert 0.95 < r["auc"] <= 1.0
        assert all(0 <= r[m] <= 1 for m in ("precision", "recall", "f1", "accuracy"))
    top = max(r["auc"] for r in rows)
    first = next(n for n, r in zip(models.ALGORITHMS, rows) if r["auc"] == top)
    assert best == first


@pytest.mark.parametrize("name", list(models.ALGORITHMS))
def test_importances_and_scores_for_every_model(separable, name):
    model = models.fit(name, separable)
    table = models.importances(model, separable, COLUMNS).collect()
    assert sorted(r["feature"] for r in table) == COLUMNS
    assert [r["importance"] for r in table] == sorted(
        (r["importance"] for r in table), reverse=True)
    pred = positive_score(model.transform(separable))
    assert pred.filter(F.col("score").isNull()).count() == 0
    assert curves.auc_roc(pred).first()["auc"] == pytest.approx(models.evaluate_auc(pred))


def test_null_feature_is_an_error(spark):
    rows = spark.createDataFrame([(1, None, 2.0)], "label int, a double, b double")
    with pytest.raises(Exception):
        models.assemble_features(rows, COLUMNS).collect()


@pytest.fixture(scope="module")
def pred(spark):
    rng = np.random.default_rng(2)
    rows = [(int(rng.random() < 0.3), float(rng.integers(0, 40)), 0.0) for _ in range(3000)]
    rows = [(y, s + 6 * y, float(s + 6 * y > 22)) for y, s, _ in rows]
    return spark.createDataFrame(rows, "label int, score double, prediction double").cache()


def test_metrics_equal_the_evaluators(pred):
    ours = curves.class_metrics(pred).first()
    for name, metric in (("precision", "weightedPrecision"), ("recall", "weightedRecall"),
                         ("f1", "f1"), ("accuracy", "accuracy")):
        theirs = MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="prediction", metricName=metric).evaluate(pred)
        assert ours[name] == pytest.approx(theirs)
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score",
                                        numBins=0).evaluate(pred)
    assert curves.auc_roc(pred).first()["auc"] == pytest.approx(auc)


def test_curve_properties(pred):
    roc = sorted(curves.roc_points(pred).collect(), key=lambda r: -r["threshold"])
    assert (roc[0]["fpr"], roc[0]["tpr"]) == (0, 0) and (roc[-1]["fpr"], roc[-1]["tpr"]) == (1, 1)
    assert len(roc) == pred.select("score").distinct().count() + 1
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(roc, roc[1:]))
    assert all(a["fpr"] <= b["fpr"] and a["tpr"] <= b["tpr"] for a, b in zip(roc, roc[1:]))
    assert area == pytest.approx(curves.auc_roc(pred).first()["auc"])
    assert curves.confusion(pred).agg(F.sum("n")).first()[0] == pred.count()


def test_curves_do_not_depend_on_the_ranges(pred):
    for fn in (curves.roc_points, curves.pr_points, curves.auc_roc):
        one = sorted(map(repr, fn(pred, ranges=2).collect()))
        assert one == sorted(map(repr, fn(pred, ranges=40).collect()))


def test_label_or_prediction_outside_the_classes_is_an_error(spark):
    for row in ((2, 1.0), (1, 3.0), (None, 1.0)):
        rows = spark.createDataFrame([(0, 0.0), row], "label int, prediction double")
        for fn in (curves.confusion, curves.class_metrics):
            with pytest.raises(Exception, match="outside"):
                fn(rows).collect()


def test_one_class_is_an_error(spark):
    rows = spark.createDataFrame([(1, 0.5)], "label int, score double")
    for fn in (curves.roc_points, curves.pr_points, curves.auc_roc):
        with pytest.raises(curves.OneClassError):
            fn(rows)


def test_batch_equals_stream_and_reloaded_model(spark, separable, tmp_path):
    model = models.fit("tree", separable)
    models.save_model(model, COLUMNS, str(tmp_path / "model"))
    loaded = models.load_model(str(tmp_path / "model"))
    records = separable.select("a", "b").distinct()
    schema = records.schema
    records.repartition(3).write.json(str(tmp_path / "requests"))
    batch = score(loaded, read_requests(spark, str(tmp_path / "requests"), schema))
    assert sorted(map(tuple, batch.collect())) == sorted(
        map(tuple, score(loaded, records).collect()))

    def run():
        stream = read_request_stream(spark, str(tmp_path / "requests"), schema, 1)
        score_stream(loaded, stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return sorted(map(tuple, read_scored(spark, str(tmp_path / "out")).collect()))

    assert run() == sorted(map(tuple, batch.collect()))
    spark.createDataFrame([(1.0, 2.0)], schema).write.mode("append").json(
        str(tmp_path / "requests"))
    assert len(run()) == records.count() + 1  # the restart scores only the new file


def test_all_stages(spark, txn, tmp_path):
    source, out = str(tmp_path / "txn"), str(tmp_path / "run")
    write_stage(txn, source)
    result = staged_run(spark, source, out, fraction=0.3, names=["tree", "bayes"])
    assert result.leaderboard.count() == 2 and result.best in ("tree", "bayes")
    for stage in ("processed", "features", "predictions", "report/roc", "report/pairs"):
        assert spark.read.parquet(f"{out}/{stage}").count() > 0
    importances = spark.read.option("header", True).csv(f"{out}/importances")
    assert importances.count() == 13
    assert models.load_model(f"{out}/model").transform(
        spark.read.parquet(f"{out}/features")).count() > 0


@pytest.fixture()
def broken_requests(spark, separable, tmp_path):
    """Three files: good lines, lines that do not parse, lines without a feature."""
    folder = tmp_path / "requests"
    folder.mkdir()
    good = [f'{{"a": {a}.5, "b": {a % 3}}}' for a in range(20)]
    bad = ['{"a": 1.0, "b"', "no json at all", '{"a": "text", "b": 2}']
    lacking = ['{"a": 1.0}', '{"b": 2}', "{}", '{"a": null, "b": 1}']
    for name, lines in (("1.json", good[:10] + bad), ("2.json", good[10:]), ("3.json", lacking)):
        (folder / name).write_text("\n".join(lines) + "\n")
    return models.PipelineModel([models.assembler(COLUMNS), models.fit("tree", separable)]), str(folder), bad


def test_stream_goes_on_behind_bad_records(spark, separable, broken_requests, tmp_path):
    model, folder, bad = broken_requests
    out, schema = str(tmp_path / "out"), separable.select("a", "b").schema

    def run():
        stream = read_request_stream(spark, folder, schema, 1)
        score_stream(model, stream, out, str(tmp_path / "cp")).awaitTermination()
        refused = spark.read.parquet(rejected_path(out))
        return read_scored(spark, out).count(), sorted(
            (r["reason"], r["bad_line"] or "") for r in refused.collect())

    want = sorted([("does not parse", b) for b in bad] + [
        ("without b", ""), ("without a", ""), ("without a, b", ""), ("without a", "")])
    assert run() == (20, want)
    assert run() == (20, want)      # nothing new, nothing twice


def test_batch_that_was_not_committed_is_not_written_twice(spark, separable, broken_requests, tmp_path):
    model, folder, _ = broken_requests
    out, schema, cp = str(tmp_path / "out"), separable.select("a", "b").schema, tmp_path / "cp"

    def run():
        score_stream(model, read_request_stream(spark, folder, schema, 1), out, str(cp)).awaitTermination()
        return read_scored(spark, out).count(), spark.read.parquet(rejected_path(out)).count()

    assert run() == (20, 7)
    for name in ("2", ".2.crc"):    # as after a failure between writing and committing
        (cp / "commits" / name).unlink(missing_ok=True)
    assert run() == (20, 7)


def test_records_split_in_batch(spark, separable):
    model = models.PipelineModel([models.assembler(COLUMNS), models.fit("tree", separable)])
    rows = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 1.0)], "a double, b double")
    good, bad = split_records(model, rows)
    assert score(model, good).count() == 1
    assert {r["reason"] for r in bad.collect()} == {"without a"} and bad.count() == 2


def test_nan_score_ranks_above_all(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, nan), (0, nan), (1, inf), (0, 0.5), (1, 0.5), (0, -inf), (1, 0.25), (0, 0.0)]
    pred = spark.createDataFrame(rows, "label int, score double")
    want = sum(1.0 if rank(p) > rank(n) else 0.5 if rank(p) == rank(n) else 0.0
               for a, p in rows if a for b, n in rows if not b) / 16
    for ranges in (None, 2, 5):
        assert curves.auc_roc(pred, ranges=ranges).first()["auc"] == pytest.approx(want)
        first = curves.roc_points(pred, ranges=ranges).filter("isnan(threshold)").first()
        assert (first["fpr"], first["tpr"]) == (0.25, 0.25)
        best = curves.pr_points(pred, ranges=ranges).filter("isnan(threshold)").first()
        assert (best["precision"], best["recall"]) == (0.5, 0.25)
    every = spark.createDataFrame([(1, nan), (0, nan)], "label int, score double")
    assert curves.auc_roc(every).first()["auc"] == 0.5


def rank(score):
    return (1, 0.0) if score != score else (0, score)


@pytest.mark.parametrize("row", [(2, 0.5), (None, 0.5), (1, None), (-1, None)])
def test_rows_outside_both_classes(spark, row):
    pred = spark.createDataFrame([(1, 0.9), (0, 0.1), row, row], "label int, score double")
    for fn in (curves.roc_points, curves.pr_points, curves.auc_roc):
        with pytest.raises(curves.UnknownRowError, match="2 rows"):
            fn(pred)
        assert fn(pred, invalid="skip").count() > 0
    assert curves.auc_roc(pred, invalid="skip").first()["auc"] == 1.0


def test_run_goes_on_where_it_stopped(spark, txn, tmp_path, monkeypatch):
    """The fourth stage fails once; the first three are not done again, and nothing is once all is done."""
    source, out, done = str(tmp_path / "txn"), str(tmp_path / "run"), []
    write_stage(txn, source)
    for name in ("process", "engineer", "report_before", "train", "report_after"):
        def traced(*args, _name=name, _work=getattr(run_plan, name)):
            done.append(_name)
            return _work(*args)
        monkeypatch.setattr(run_plan, name, traced)

    def go(**how):
        done.clear()
        result = staged_run(spark, source, out, names=["tree", "bayes"], **{"fraction": 0.3, **how})
        return list(done), result

    with monkeypatch.context() as m:
        def broken(*_):
            raise RuntimeError("an executor too many was lost")
        m.setattr(run_plan, "importances", broken)      # in the midst of the fourth stage
        with pytest.raises(RuntimeError, match="lost"):
            go()
    assert done == ["process", "engineer", "report_before", "train"]
    again, result = go()
    assert again == ["train", "report_after"] and result.leaderboard.count() == 2
    whole = sorted(map(tuple, result.leaderboard.collect()))
    again, result = go()
    assert again == [] and result.best in ("tree", "bayes")
    assert sorted(map(tuple, result.leaderboard.collect())) == whole
    assert Manifest(spark, out).read("train")["value"] == result.best

    shutil.rmtree(f"{out}/features")                    # a result that is gone is made again
    assert go()[0] == ["engineer"]
    assert go(fraction=0.31)[0] == ["process", "engineer", "report_before", "train", "report_after"]
    write_stage(txn.limit(5000), source)                # another source
    assert go(fraction=0.31)[0][0] == "process"


@pytest.mark.parametrize("name", sorted(models.STORES_OWN_INPUT))
def test_tree_fit_stores_no_second_copy_of_the_rows(spark, separable, name, monkeypatch):
    stored = []
    real = models.DataFrame.persist

    def persist(df, *args, **kwargs):
        stored.append(df)
        return real(df, *args, **kwargs)

    monkeypatch.setattr(models.DataFrame, "persist", persist)
    model = models.fit(name, separable.select("features", "label"))
    assert stored == []
    pred = model.transform(separable)
    assert pred.filter(F.col("prediction") != F.col("label")).count() == 0
