import random

import numpy as np
import pytest
from brute import repeats

from ledgersift.llm.suffix_repeats import remove_repeats, repeated_windows


def digest(docs, **sizes):
    rows = remove_repeats(docs, **sizes).collect()
    return sorted(((r.id, len(r.text), len(r.text) - len(r.kept), len(r.spans), r.kept_sha256)
                   for r in rows), key=repr)


def expected(rows, length):
    return sorted(((i, *rest) for (i, _, _), rest in zip(
        rows, repeats([t for _, t, _ in rows], length))), key=repr)


def messy(seed, n=24):
    rng = random.Random(seed)
    base = "".join(rng.choices("abcdé ", k=900))
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.4:
            a = rng.randrange(600)
            t = base[a:a + rng.randint(20, 300)]
        elif kind < 0.6:
            t = "".join(rng.choices("abcdé ", k=rng.randint(0, 300)))
        elif kind < 0.75:
            t = rng.choice(["ab", "a", "abc"]) * rng.randint(5, 120)
        else:
            t = "x" + base[:rng.randint(0, 200)] + str(i) + base[300:350 + rng.randrange(100)]
        rows.append((i, t, "a"))
    return rows + rows[:2]


@pytest.mark.parametrize("length", [3, 9, 20, 40])
def test_windows_of_random_texts(length):
    for seed in range(12):
        texts = [t.encode() for _, t, _ in messy(seed) if len(t.encode()) >= length]
        seen = {}
        for t in texts:
            for i in range(len(t) - length + 1):
                seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
        got = repeated_windows(texts, [np.ones(len(t) - length + 1, int) for t in texts], length)
        for t, flags in zip(texts, got):
            assert [seen[t[i:i + length]] > 1 for i in range(len(t) - length + 1)] == flags.tolist()


@pytest.mark.parametrize("length,width,crowd", [(40, 16, 1 << 20), (40, 40, 1 << 20), (25, 8, 1), (40, 16, 200)])
def test_against_brute_force(make_docs, length, width, crowd):
    rows = messy(length + width)
    assert digest(make_docs(rows), length=length, width=width, crowd_bytes=crowd) == expected(rows, length)


def test_edges(make_docs, edges):
    docs = make_docs(edges)
    assert digest(docs) == expected(edges, 400)
    assert digest(docs, length=20, width=8) == expected(edges, 20)
    assert remove_repeats(docs.limit(0)).count() == 0


def test_hot_passage_with_own_surroundings(make_docs):
    """One passage in all documents, so that its seeds have a class per document."""
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdefg", k=120))
    rows = [(i, "".join(rng.choices("hijkl", k=60)) + passage + "".join(rng.choices("hijkl", k=60)), "a")
            for i in range(60)]
    want = expected(rows, 50)
    assert digest(make_docs(rows), length=50, width=16) == want
    assert digest(make_docs(rows), length=50, width=16, crowd_bytes=500) == want
    assert all(120 <= r[2] < 140 for r in want)
