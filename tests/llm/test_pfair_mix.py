import random
from collections import Counter

import pytest
from brute import mix

from ledgersift.llm.pfair_mix import mix_sources, root_weights


def rows(sizes):
    out = [(s, i) for s, n in sizes.items() for i in range(n)]
    return [(k, None, s) for k, (s, _) in enumerate(out)]


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 7, "b": 1, "c": 5, "d": 4}])
def test_against_simulation(spark, make_docs, weights):
    data = rows({s: 40 + 13 * k for k, s in enumerate(sorted(weights))})
    shares = spark.createDataFrame(list(weights.items()), "source string, weight int")
    got = mix_sources(make_docs(data), weights=shares, block_rows=3)
    want = mix([(i, s) for i, _, s in data], weights, 3)
    assert {r.doc_id: (r.mix_slot, r.mix_position) for r in got.collect()} == want


def test_less_than_one_block_off(spark, make_docs):
    weights = {f"s{k}": w for k, w in enumerate([17, 1, 9, 9, 4, 23])}
    data = rows({s: 30 * w for s, w in weights.items()})
    shares = spark.createDataFrame(list(weights.items()), "source string, weight int")
    placed = sorted((r.mix_slot, r.source) for r in mix_sources(
        make_docs(data), weights=shares, block_rows=10).select("mix_slot", "source").distinct().collect())
    total, got = sum(weights.values()), Counter()
    for n, (slot, source) in enumerate(placed):
        assert slot == n
        got[source] += 1
        assert all(abs(got[s] - w * (n + 1) / total) < 1 for s, w in weights.items())


def test_root_weights_add_up(spark):
    rng = random.Random(3)
    counts = [(f"k{i}", rng.randint(1, 10_000)) for i in range(37)]
    table = root_weights(spark.createDataFrame(counts, "key string, rows bigint"), 1000).collect()
    assert sum(r.weight for r in table) == 1000 and min(r.weight for r in table) >= 1
    with pytest.raises(Exception, match="more sources than slots"):
        root_weights(spark.createDataFrame(counts, "key string, rows bigint"), 10).collect()


def test_edges(spark, make_docs, edges):
    docs = make_docs(edges)
    got = mix_sources(docs).collect()
    assert sorted(r.mix_position for r in got) == list(range(len(edges)))
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id) == sorted((i, t) for i, t, _ in edges if i)
    assert mix_sources(docs.limit(0)).count() == 0
    some = spark.createDataFrame([("a", 1), ("b", 1)], "source string, weight int")
    with pytest.raises(Exception, match="no weight for source"):
        mix_sources(docs, weights=some).collect()


def test_buckets_do_not_change_the_order(spark, make_docs, monkeypatch):
    from ledgersift.llm import pfair_mix
    data = rows({"a": 300, "b": 120})
    whole = {r.doc_id: r.mix_position for r in mix_sources(make_docs(data)).collect()}
    monkeypatch.setattr(pfair_mix.numbered, "__defaults__", (7,))
    assert {r.doc_id: r.mix_position for r in mix_sources(make_docs(data)).collect()} == whole


def test_more_sources_than_slots(make_docs):
    rng = random.Random(5)
    data = rows({f"h{k}": rng.randint(1, 3) for k in range(1300)} | {"big": 900, None: 40})
    got = mix_sources(make_docs(data)).select("doc_id", "source", "mix_slot", "mix_position").collect()
    assert sorted(r.doc_id for r in got) == [i for i, _, _ in data]
    assert sorted(r.mix_position for r in got) == list(range(len(data)))
    in_place = [r.mix_slot for r in sorted(got, key=lambda r: r.mix_position)]
    assert in_place == sorted(in_place)


@pytest.mark.parametrize("weighted", [True, False])
def test_many_sources_against_simulation(spark, make_docs, weighted):
    rng = random.Random(7)
    data = rows({f"s{k:02}": rng.randint(1, 60) for k in range(30)})
    docs, sizes = make_docs(data), Counter(s for _, _, s in data)
    if weighted:
        weights = {s: rng.randint(1, 9) for s in sizes}
        shares = spark.createDataFrame(list(weights.items()), "source string, weight int")
        got = mix_sources(docs, weights=shares, block_rows=3, cycle=7)
    else:
        counts = spark.createDataFrame([("s" + s, n) for s, n in sizes.items()], "key string, rows bigint")
        weights = {r.key[1:]: r.weight for r in root_weights(counts, 4 * len(sizes)).collect()}
        got = mix_sources(docs, block_rows=3, cycle=7)
    want = mix([(i, s) for i, _, s in data], weights, 3)
    assert {r.doc_id: (r.mix_slot, r.mix_position) for r in got.collect()} == want
