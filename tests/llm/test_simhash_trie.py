import random

import numpy as np
import pytest
from brute import components, simhash

from ledgersift.llm.components import connected_components
from ledgersift.llm.simhash_trie import (
    drop_near_copies, fingerprint, simhash_components, trie_links, visit)


@pytest.mark.parametrize("text", ["", " ", "one", "One two", "a b c", "a b c d " * 5, "É é ß x y z"])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == simhash(text)


def clustered(n, seed):
    rng = random.Random(seed)
    values = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(values) < n:
        v = rng.choice(values)
        for _ in range(rng.randint(1, 4)):
            v ^= 1 << rng.randrange(64)
        values.append(v)
    return sorted(set(values))


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_visit_finds_all_pairs(budget):
    values = clustered(400, budget)
    a = np.array(values, dtype=np.uint64)
    got = {(int(x), int(y)) for i, j in visit(a, a, True, 0, budget) for x, y in zip(i, j)}
    want = {(i, j) for j in range(len(values)) for i in range(j)
            if (values[i] ^ values[j]).bit_count() <= budget}
    assert got == want


@pytest.mark.parametrize("node_rows", [4, 64, 100_000])
def test_components_do_not_depend_on_the_node_size(spark, node_rows):
    values = clustered(500, 7)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "_print bigint")
    found = {r.node: r.root for r in connected_components(
        trie_links(prints, 2, node_rows)).collect()}
    assert [found.get(v, v) for v in signed] == components(values, signed, 2)


def test_crowded_node_is_opened(spark):
    """All fingerprints share their upper bits: the trie is opened level by level."""
    values = sorted({random.Random(i).getrandbits(14) for i in range(300)})
    prints = spark.createDataFrame([(v,) for v in values], "_print bigint")
    found = {r.node: r.root for r in connected_components(trie_links(prints, 2, 8)).collect()}
    assert [found.get(v, v) for v in values] == components(values, values, 2)


def test_edges(make_docs, edges):
    rows = [r for r in edges if r[0] is not None]
    got = simhash_components(make_docs(rows))
    prints = [simhash(t) for _, t, _ in rows]
    want = zip([r[0] for r in rows], prints, components(prints, [r[0] for r in rows], 2))
    assert sorted((r._id, r._print % (1 << 64), r.component_id) for r in got.collect()) == sorted(want)
    docs = make_docs(edges)
    assert simhash_components(docs).count() == len(edges)
    assert drop_near_copies(docs).columns == docs.columns
    assert simhash_components(docs.limit(0)).count() == 0
    only_null = docs.filter("doc_id IS NULL")
    assert {r.component_id for r in simhash_components(only_null).collect()} == {None}


def test_one_of_each_component_stays(make_docs):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(i, text if i else text + " more", "a") for i in range(20)] + [(99, "other words here", "b")]
    kept = sorted(r.doc_id for r in drop_near_copies(make_docs(rows)).collect())
    prints = [simhash(t) for _, t, _ in rows]
    assert kept == sorted(set(components(prints, [r[0] for r in rows], 2)))


def test_long_chain_of_links(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a bigint, b bigint")
    found = connected_components(edges).collect()
    assert {r.node for r in found} == set(range(n + 1)) and {r.root for r in found} == {0}
