import hashlib

from brute import normalised

from ledgersift.llm.exact_dedup import drop_copies, exact_dedup


def expected(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(normalised(t), []).append(i)
    out = []
    for i, t, _ in rows:
        n = normalised(t)
        keep = min((k for k in groups[n] if k is not None), default=None)
        out.append((i, keep, len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edges(make_docs, edges):
    got = exact_dedup(make_docs(edges))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(edges)


def test_equal_length_and_prefix_are_told_apart(make_docs):
    base = "p" * 600
    rows = [(i, base + str(i % 3), "a") for i in range(9)]
    assert sorted(map(tuple, exact_dedup(make_docs(rows)).collect()), key=repr) == expected(rows)


def test_dropped_rows(make_docs, edges):
    docs = make_docs(edges)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    want = [(i, t) for (i, t, _) in edges]
    for gone in [(2, edges[1][1]), (6, edges[5][1]), (4, ""), (None, None)]:
        want.remove(gone)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(make_docs, edges):
    docs = make_docs(edges).limit(0)
    assert exact_dedup(docs).count() == 0 and drop_copies(docs).count() == 0
