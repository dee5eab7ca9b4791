import hashlib
import random

import pytest

from ledgersift.llm.line_chunks import cut_lines, remove_repeated_chunks


def brute(rows, **sizes):
    chunks, seen = [], {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    for k in order:
        lines = (rows[k][1] or "").encode().split(b"\n")
        for first, n, _ in cut_lines(lines, **sizes):
            if n >= 2:
                chunks.append((k, first, n, b"\n".join(lines[first:first + n])))
    for k, first, n, text in chunks:
        seen.setdefault(text, (rows[k][0], rows[k][1], first))
    out = []
    for k, (i, t, _) in enumerate(rows):
        lines, gone = (t or "").encode().split(b"\n"), set()
        for c, first, n, text in chunks:
            if c == k and seen[text] != (i, t, first):
                gone.update(range(first, first + n))
        kept = b"\n".join(x for j, x in enumerate(lines) if j not in gone)
        out.append((i, len(lines), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(docs, **sizes):
    return sorted(((r.id, r.n_lines, r.n_removed, hashlib.sha256(r.kept).hexdigest())
                   for r in remove_repeated_chunks(docs, **sizes).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"window": 1, "sparsity": 2}, {"window": 3, "sparsity": 4, "max_lines": 5}])
def test_against_brute_force(make_docs, sizes):
    rng = random.Random(9)
    block = [f"shared line {k}" for k in range(30)]
    rows = []
    for i in range(25):
        lines = [f"own {i} {k}" for k in range(rng.randint(0, 12))]
        at = rng.randint(0, len(lines))
        a = rng.randrange(20)
        lines[at:at] = block[a:a + rng.randint(0, 20)] if rng.random() < 0.7 else ["same"] * rng.randint(0, 90)
        rows.append((i, "\n".join(lines), "a"))
    assert got(make_docs(rows), **sizes) == brute(rows, **sizes)


def test_boundaries_do_not_shift():
    lines = [b"line %d" % i for i in range(400)]
    whole = {tuple(lines[f:f + n]) for f, n, _ in cut_lines(lines)}
    moved = [b"new first"] + lines
    shifted = {tuple(moved[f:f + n]) for f, n, _ in cut_lines(moved)}
    assert len(whole - shifted) <= 2
    assert sum(n for _, n, _ in cut_lines(lines)) == 400


def test_edges(make_docs, edges):
    docs = make_docs([(i, t, s) for i, t, s in edges])
    assert got(docs) == brute(edges)
    assert remove_repeated_chunks(docs.limit(0)).count() == 0
