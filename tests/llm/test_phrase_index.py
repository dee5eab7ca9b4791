from brute import contamination as brute
from brute import words

from ledgersift.llm.phrase_index import (
    build_index, contamination, drop_contaminated, phrase_hits, split_words, test_windows)

test_windows.__test__ = False

ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item"),
         (3, None), (4, ""), (5, "one two three four five six seven eight nine TEN"), (None, "no name"),
         (2, "Short item")]
DOCS = [(1, "x One two, three four five six seven eight nine ten! eleven twelve", "a"),
        (2, "a short item, and a short item", "a"), (3, "one two three four five six seven eight nine", "b"),
        (4, "short short item item", "b"), (5, "no name no name", "b"), (6, "nothing", "a")]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def check(docs, rows, spark, **sizes):
    named = [("" if i is None else i, t) for i, t in ITEMS]
    want = sorted(((i, n, sorted(hit), found) for (i, _, _), (n, hit, found) in
                   zip(rows, brute([t for _, t, _ in rows], named))), key=repr)
    got = sorted(((r._id, r.n_words, list(r.hit), list(r["items"]))
                  for r in contamination(docs, items(spark), **sizes).collect()), key=repr)
    assert got == want


def test_words():
    text = "Héllo, WORLD 12x y\x7fz_ß"
    assert [w.decode() for w in split_words(text.encode())] == words(text)


def test_against_brute_force(spark, make_docs, edges):
    for shard in (3, 1 << 20):
        check(make_docs(DOCS + edges), DOCS + edges, spark, shard_words=shard)


def test_blocks_of_windows(spark, make_docs):
    index = build_index(make_docs(DOCS))
    windows = test_windows(items(spark))
    whole = sorted(map(tuple, phrase_hits(index, windows).collect()), key=repr)
    assert sorted(map(tuple, phrase_hits(index, windows, block_windows=1).collect()), key=repr) == whole


def test_matches_do_not_cross_documents(spark, make_docs):
    rows = [(1, "short", "a"), (2, "item", "a")]
    check(make_docs(rows).coalesce(1), rows, spark)


def test_proximity(spark, make_docs):
    rows = [(1, "item that is short", "a"), (2, "item " + "far " * 20 + "short", "a")]
    found = phrase_hits(build_index(make_docs(rows)), test_windows(items(spark)), slop=4).collect()
    assert [(r.id, list(r["items"])) for r in found] == [(1, ["2"])]


def test_drop_and_empty_tables(spark, make_docs):
    docs = make_docs(DOCS)
    kept = drop_contaminated(docs, items(spark))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6]
    assert contamination(docs.limit(0), items(spark)).count() == 0
    assert drop_contaminated(docs, items(spark).limit(0)).count() == len(DOCS)
