import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgersift.llm import quality
from ledgersift.llm.common import read_table
from ledgersift.llm.quality import fit_quality, keep_good, score_quality


def rated(n, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(n):
        grade = rng.choice([0, 1, 2, 2])
        w = rng.choices(vocabulary, k=30) + {0: ["vile"] * 2, 1: ["%%%"] * 3, 2: []}[grade]
        rng.shuffle(w)
        rows.append((i, " ".join(w), "a"))
        labels.append((i, grade))
    return rows, labels


def test_held_out_accuracy(spark, make_docs):
    rows, labels = rated(600)
    docs = make_docs(rows)
    grades = spark.createDataFrame(labels, "doc_id bigint, grade int")
    model = quality.fit_quality(docs, grades.filter("doc_id < 400"))
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    right = sum(got[i].kept == (g == 2) for i, g in labels if i >= 400)
    assert right >= 190
    mean = [np.mean([got[i].expected_grade for i, g in labels if g == k and i >= 400]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    for i, text, _ in rows[:20]:
        tails = model.tails(np.array([model.score(text.encode())]))[0]
        assert abs(got[i].p_tail - tails[1]) < 1e-6 and abs(got[i].expected_grade - tails.sum()) < 1e-6


def test_gradient_lowers_the_loss_of_a_known_case():
    rows = [np.array([0]), np.array([1]), np.array([2])] * 30
    model = quality.fit_ordinal(rows, np.array([0, 1, 2] * 30), 3, buckets=8, min_share=0.0, ridge=0.0)
    p = model.tails(np.array([model.weights[k] for k in range(3)]))
    assert p[0][0] < 0.5 < p[1][0] and p[1][1] < 0.5 < p[2][1]


def test_edges(spark, make_docs, edges):
    docs = make_docs(edges)
    none = spark.createDataFrame([], "doc_id bigint, grade int")
    even = quality.score_quality(docs, quality.fit_quality(docs, none)).collect()
    assert len(even) == len(edges) and {r.p_tail for r in even} == {0.5}
    some = spark.createDataFrame([(1, 2), (3, 0), (5, 2), (8, 1), (None, 1), (9, None)],
                                 "doc_id bigint, grade int")
    model = quality.fit_quality(docs, some)
    rows = quality.score_quality(docs, model).collect()
    assert len(rows) == len(edges) and all(0 <= r.p_tail <= 1 for r in rows)
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.score_quality(docs.limit(0), model).count() == 0


def test_sample_is_bounded(spark, make_docs):
    rows, labels = rated(200)
    grades = spark.createDataFrame(labels, "doc_id bigint, grade int")
    small = quality.fit_quality(make_docs(rows), grades, sample_rows=50)
    again = quality.fit_quality(make_docs(rows[::-1]), grades, sample_rows=50)
    assert np.allclose(small.weights, again.weights, atol=1e-4)


def test_toxic_and_poor_documents_go(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = read_table(spark, d, "documents"), quality.grades(read_table(spark, d, "labels"))
    model = quality.fit_quality(docs, labels)
    rows = quality.score_quality(docs, model).join(labels, "doc_id").filter("grade IS NOT NULL").collect()
    assert np.mean([r.kept == (r.grade == 2) for r in rows]) > 0.97


def test_columns_of_any_name_and_unseen_grades(spark, make_docs):
    docs = make_docs([(i, "good words here" if i % 2 else "bad words there", "a") for i in range(60)]).withColumn(
        "grade", F.lit("x")).withColumn("_rated", F.lit(1)).withColumn("_grade", F.lit(2.5))
    ratings = spark.createDataFrame([(i, i % 2, 7) for i in range(60)], "doc_id bigint, grade int, text int")
    model = fit_quality(docs, ratings)
    rows = score_quality(docs, model).collect()
    assert {r.p_tail for r in rows} == {0.0} and not any(r.kept for r in rows)   # grade 2 was never seen
    kept = {r.doc_id for r in score_quality(docs, model, keep_grade=1).filter("kept").collect()}
    assert kept == {i for i in range(60) if i % 2}
    assert keep_good(docs, model).count() == 0 and keep_good(docs, model, keep_grade=1).count() == 30
    assert keep_good(docs, model, keep_grade=0).count() == 60
    nothing = fit_quality(docs, ratings.limit(0))
    assert {r.p_tail for r in score_quality(docs, nothing, keep_grade=2).collect()} == {0.5}


@pytest.mark.parametrize("grade", [-1.0, 0.5])
def test_grades_that_are_none(spark, make_docs, grade):
    docs = make_docs([(i, "words", "a") for i in range(4)])
    ratings = spark.createDataFrame([(1, 1.0), (2, grade)], "doc_id bigint, grade double")
    with pytest.raises(Exception, match="whole number"):
        fit_quality(docs, ratings)
