"""Registered queries: SQL where there is some, and the pipeline against brute force."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import compare, duck
from ledgersift.llm import pfair_mix, quality
from ledgersift.llm.common import read_table
from ledgersift.llm.oracle import ORACLE
from ledgersift.llm.queries import QUERIES

WITHOUT_SQL = {"op2_passage_chains", "op3_ordinal_quality", "op6_line_chunks", "op8_licence_rules", "op12_jacobi_whitening",
               "op10_simhash_trie", "pipeline"}


def test_registered():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("key", list(ORACLE))
def test_same_rows(spark, folder, key):
    assert compare(spark, duck(folder), key, folder, ORACLE[key])[0] == "same"


def test_simhash_query(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text").collect()
    prints = [brute.simhash(r.text) for r in docs]
    roots = brute.components(prints, [r.doc_id for r in docs], 2)
    want = sorted((r.doc_id, f"{p:016x}", c) for r, p, c in zip(docs, prints, roots))
    assert sorted(map(tuple, QUERIES["op10_simhash_trie"](spark, folder).collect())) == want


def test_pipeline_stages(spark, folder):
    docs = read_table(spark, folder, "documents")
    labels = quality.grades(read_table(spark, folder, "labels"))
    model = quality.fit_quality(docs, labels)
    rows = {r.doc_id: r for r in docs.collect()}
    scores = np.array([model.score((r.text or "").encode()) for r in rows.values()])
    odds = dict(zip(rows, model.tails(scores)[:, 1]))
    good = {i for i, p in odds.items() if p >= 0.5}
    sure = {i for i, p in odds.items() if abs(p - 0.5) > 1e-3}

    first = corpus_pipeline.STAGES[0][1](spark, docs, folder)
    kept = {r.doc_id for r in first.collect()}
    assert kept & sure == good & sure and first.columns == docs.columns

    least = {}
    for i in sorted(kept):
        least.setdefault(brute.normalised(rows[i].text), i)
    kept = set(least.values())
    now = docs.filter(F.col("doc_id").isin(list(kept | {-1})))
    again = corpus_pipeline.STAGES[1][1](spark, first, folder)
    assert {r.doc_id for r in again.collect()} == kept and again.columns == docs.columns

    ids = sorted(kept)
    roots = brute.components([brute.simhash(rows[i].text) for i in ids], ids, 2)
    kept = {i for i, c in zip(ids, roots) if i == c}
    again = corpus_pipeline.STAGES[2][1](spark, now, folder)
    assert {r.doc_id for r in again.collect()} == kept and again.columns == docs.columns

    ids = sorted(kept)
    items = [(r.item_id, r.text) for r in read_table(spark, folder, "benchmark").collect()]
    hits = brute.contamination([rows[i].text for i in ids], items)
    now = docs.filter(F.col("doc_id").isin([*ids, -1]))
    kept = {i for i, (_, hit, _) in zip(ids, hits) if not hit}
    again = corpus_pipeline.STAGES[3][1](spark, now, folder)
    assert {r.doc_id for r in again.collect()} == kept and again.columns == docs.columns

    counts = again.groupBy(pfair_mix.source_key(F.col("source")).alias("key")).agg(
        F.count(F.lit(1)).alias("rows"))
    weights = {r.key: r.weight for r in pfair_mix.root_weights(counts).collect()}
    want = brute.mix([(i, "s" + rows[i].source) for i in kept], weights, pfair_mix.BLOCK_ROWS)
    mixed = corpus_pipeline.STAGES[4][1](spark, again, folder)
    assert {r.doc_id: (r.mix_slot, r.mix_position) for r in mixed.collect()} == want

    run = {r.doc_id: r.mix_position for r in corpus_pipeline.run(spark, folder).collect()}
    assert run == {i: p for i, (_, p) in want.items()}


def test_pipeline_takes_edge_rows(spark, make_docs, edges, folder):
    docs = make_docs([r for r in edges if r[0] != 5 and r[0] != 6])
    now = docs
    for _, step in corpus_pipeline.STAGES[1:4]:
        now = step(spark, now, folder)
        assert now.columns == docs.columns
    assert corpus_pipeline.STAGES[4][1](spark, now, folder).count() == now.count() > 3
    empty = docs.limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, folder).count() == 0
