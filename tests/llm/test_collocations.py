import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgersift.llm import collocations as co
from ledgersift.llm import count_automata as automata
from ledgersift.llm.common import utf8


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def phrase_counts(texts):
    found = Counter()
    for text in texts:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                found.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    return found


def brute(rows, min_count=10, min_share=50, first=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    by_lang, out = {}, []
    for text, lang in rows:
        by_lang.setdefault("und" if lang is None else lang, []).append(text)
    for lang, texts in by_lang.items():
        f = phrase_counts(texts)
        n = sum(c for p, c in f.items() if len(p) == 1)
        able = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        kept = []
        for p, a in able.items():
            longer = [c for q, c in able.items() if len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * c >= min_share * a for c in longer):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(docs, **how):
    return sorted(map(tuple, co.collocations(docs, **how).collect()))


def random_text(rng, vocabulary, n):
    words = [rng.choice(vocabulary) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! "]) for w in words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    vocabulary = ["New", "york", "CITY", "é", "ÀB", "a", "b", "c", "x y", "it's", "日本", "\x1c"]
    made = [(random_text(rng, vocabulary, rng.randint(0, 60)), rng.choice(["en", "en", "en", "fr", None]))
            for _ in range(150)]
    return made + [("one two three. " * 12, "en"), (None, "en"), ("", "zz"), (" \n.", "zz"), ("tiny", "de")]


@pytest.mark.parametrize("how", [{}, {"min_count": 3}, {"min_share": 5}, {"first": 7}, {"per_range": 640}])
def test_against_brute_force(spark, rows, how):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert got(docs, **how) == brute(rows, **{k: v for k, v in how.items() if k != "per_range"})


def test_full_and_split_shards(spark, rows, monkeypatch):
    """Shards that fill up within a text lose no phrase and count none twice."""
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    monkeypatch.setattr(co, "SHARD_TOKENS", 5)
    monkeypatch.setattr(co, "SLICE_BYTES", 7)
    assert got(docs) == brute(rows)


def test_many_ranges_within_one_word(spark):
    """A word that begins a third of all phrases fills many ranges."""
    rng = random.Random(5)
    rows = [(" ".join(w for _ in range(20) for w in ("the", f"w{rng.randrange(12)}", f"v{rng.randrange(3)}")), "en")
            for _ in range(120)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    texts = docs.select("lang", utf8(F.col("text")).alias("text"))
    bounds = co.range_bounds(texts, per_range=60, sample=4)
    assert sum(b[0] == b"the" for b in bounds["en"]) > 1
    counts = co.phrase_counts(texts, bounds, 1)
    assert counts.count() == len(bounds["en"]) + 1
    found = Counter()
    for r in counts.collect():
        p = automata.expand(automata.from_bytes(bytes(r.block)))
        found.update(dict(zip(p.texts(), p.counts.tolist())))
    assert found == {" ".join(p): c for p, c in phrase_counts([t for t, _ in rows]).items()}
    assert got(docs, per_range=256) == brute(rows)


def test_edges(spark, make_docs, edges):
    docs = make_docs(edges).withColumn("lang", F.when(F.col("doc_id") < 6, "en"))
    rows = [(t, "en" if i is not None and i < 6 else None) for i, t, _ in edges]
    assert got(docs) == brute(rows)
    assert got(docs.limit(0)) == []


def test_counts_beyond_64_bits(spark):
    """Products of counts pass 64 bits; quotients are still exact."""
    a, left, right = 3_000_000_019, 3_000_000_037, 4_000_000_007
    cell = "CAST({} AS decimal(16,0))"
    sql = f"1000000 * {cell.format(a)} * {cell.format(a)} div ({cell.format(left)} * {cell.format(right)})"
    assert spark.sql(f"SELECT {sql} AS s").first().s == 1_000_000 * a * a // (left * right)


def phrases(counts):
    words = sorted({w for p in counts for w in p})
    keys = sorted(counts)
    rows = [[words.index(w) + 1 for w in p] + [0] * (3 - len(p)) for p in keys]
    return automata.Phrases(words, np.array(rows, dtype=np.int64).reshape(-1, 3),
                            np.array([counts[p] for p in keys], dtype=np.int64))


def as_counts(found):
    return {tuple(t.encode().split(b" ")): c for t, c in zip(found.texts(), found.counts.tolist())}


def random_counts(rng, n):
    letters = [b"a", b"b", b"cc", "é".encode()]
    return {tuple(rng.choices(letters, k=rng.randint(1, 3))): rng.randint(1, 3) for _ in range(n)}


@pytest.mark.parametrize("n", [0, 1, 5, 40, 200])
def test_automata(n):
    rng = random.Random(n)
    counts, more = random_counts(rng, n), random_counts(rng, n)
    machine = automata.build(phrases(counts))
    assert as_counts(automata.expand(machine)) == counts
    again = automata.from_bytes(automata.to_bytes(machine))
    assert as_counts(automata.expand(again)) == counts
    both = automata.union([phrases(counts), phrases(more), phrases({})])
    assert as_counts(both) == Counter(counts) + Counter(more)
    assert automata.compose(again, phrases(more)).tolist() == [counts.get(p, 0) for p in sorted(more)]
    for bound in [(b"a",), (b"b", b"a"), (b"cc", b"zz", b"a"), (b"A",), (b"zz",), (b"cc", b"cc", b"cc")]:
        assert phrases(counts).place(bound) == sum(p < bound for p in counts)
    cut = phrases(counts).place((b"b",))
    low, high = phrases(counts).part(0, cut), phrases(counts).part(cut, len(counts))
    assert {**as_counts(low), **as_counts(high)} == counts


def test_equal_states_are_kept_once():
    counts = {(a, b, c): 2 for a in (b"a", b"b", b"c") for b in (b"x", b"y") for c in (b"p", b"q")}
    machine = automata.build(phrases(counts))
    assert [len(b) - 1 for b in machine.begins] == [1, 2, 2]      # with one empty state below the root
    assert [len(a) for a in machine.arcs] == [3, 2, 2]
