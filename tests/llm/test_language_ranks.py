import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgersift.llm.common import read_table
from ledgersift.llm.language_ranks import identify, learn_profiles
from ledgersift.llm.queries import QUERIES


def brute_grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    line = " " + " ".join(words) + " " if words else ""
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            gram = line[i:i + n]
            if gram != " " and not (n == 3 and gram[1] == " "):
                out[gram] += 1
    return out


def brute_order(counts, top):
    def number(gram):
        return [ord(c) for c in gram] + [0] * (3 - len(gram))
    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:top]


def brute(rows, learned, top):
    """[(id, lang, score)] of (id, text) rows, with profiles from (text, lang) rows."""
    totals = {}
    for text, lang in learned:
        if text is not None and lang is not None:
            totals.setdefault(lang, Counter()).update(brute_grams(text))
    places = {lang: {g: i for i, g in enumerate(brute_order(c, top))} for lang, c in totals.items() if c}
    out = []
    for key, text in rows:
        order = brute_order(brute_grams(text), top)
        if not order or not places:
            out.append((key, "und", 0.0))
            continue
        far = {lang: sum(min(top, abs(i - p[g])) if g in p else top for i, g in enumerate(order))
               for lang, p in places.items()}
        best = min(sorted(far), key=far.get)
        out.append((key, best, 1.0 - far[best] / (len(order) * top)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("top", [5, 60, 400])
def test_against_brute_force(spark, top):
    rng = random.Random(top)
    words = {"en": "the and of thing over İstanbul", "de": "der und straße über Öl", "fr": "le été ça où Œuvre"}
    rows = [(i, " ".join(rng.choices(words[lang].split(), k=rng.randint(0, 30))) + rng.choice(["", "!3", " \n"]),
             lang) for i in range(120) for lang in [rng.choice(list(words))]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    learned = docs.filter("doc_id % 3 <> 0")
    got = identify(docs, learn_profiles(learned, top=top), top=top).collect()
    want = brute([(i, t) for i, t, _ in rows], [(t, lang) for i, t, lang in rows if i % 3], top)
    assert sorted(map(tuple, got), key=repr) == want


def test_edges(spark, make_docs, edges):
    docs = make_docs(edges).withColumn("lang", F.when(F.col("doc_id") == 1, "en")
                                       .when(F.col("doc_id") == 9, "fr"))
    got = identify(docs, learn_profiles(docs)).collect()
    learned = [(t, {1: "en", 9: "fr"}.get(i)) for i, t, _ in edges]
    assert sorted(map(tuple, got), key=repr) == brute([(i, t) for i, t, _ in edges], learned, 400)
    assert {r.lang_pred for r in got if r.id in (3, 4, 7)} == {"und"}
    assert identify(docs.limit(0), learn_profiles(docs)).count() == 0
    nothing = identify(docs, learn_profiles(docs.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)} and len(nothing) == len(edges)


def test_equally_near_languages(spark):
    docs = spark.createDataFrame([(1, "same", "zz"), (2, "same", "aa")], "doc_id int, text string, lang string")
    assert {r.lang_pred for r in identify(docs, learn_profiles(docs)).collect()} == {"aa"}


def test_too_many_languages(spark):
    docs = spark.range(5).selectExpr("id AS doc_id", "'abc' AS text", "cast(id AS string) AS lang")
    with pytest.raises(ValueError, match="language profiles"):
        identify(docs, learn_profiles(docs), top=9, max_languages=2)


def test_query_learns_from_four_fifths_only(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in docs}
    want = brute([(r.doc_id, r.text) for r in docs],
                 [(r.text, r.lang) for r in docs if not held[r.doc_id]], 400)
    got = QUERIES["op11_language_ranks"](spark, folder).collect()
    assert sorted(((r.doc_id, r.lang_pred, r.score) for r in got), key=repr) == want
    assert {r.doc_id: r.held_out for r in got} == held
    lang = {r.doc_id: r.lang for r in docs}
    unseen = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(unseen) / len(unseen) >= 0.97
