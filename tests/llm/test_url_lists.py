import random

import pytest

from ledgersift.llm.url_lists import judge_urls, validity

EVENTS = "list string, scope string, value string, action string, at bigint, added boolean"
CAPTURES = "page_id bigint, url string, fetched_at bigint, value string, slice int, best string"


def brute(captures, events):
    closed = []
    for e in set(events):
        if None in (e[2], e[4], e[5]) or not e[5]:
            continue
        same = sorted({f for f in events if f[:3] == e[:3] and None not in (f[2], f[4], f[5])},
                      key=lambda f: (f[4], not f[5], f[3] or ""))
        after = same[same.index(e) + 1:]
        closed.append((*e[:4], e[4], after[0][4] if after else None))
    out = []
    for page, url, at in captures:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:].split("?")[0].split("#")[0]
            host = host.rsplit(":", 1)[0] if ":" in host else host
        folders = [p for p in path.split("/") if p]
        values = {("host", host)} | {("domain", ".".join(host.split(".")[k:])) for k in range(host.count(".") + 1)}
        values |= {("prefix", host + "/" + "/".join(folders[:k])) for k in range(1, len(folders) + 1)}
        fits = [({"prefix": 3, "host": 2, "domain": 1}[s], len(v), since, name, action, v, s)
                for name, s, v, action, since, until in closed
                if host and at is not None and (s, v) in values and since <= at and (until is None or at < until)]
        best = max(fits, default=None)
        out.append((page, best and best[4], best and best[6], best and best[5],
                    not best or best[4] != "block"))
    return sorted(out, key=repr)


def got(spark, captures, events, **sizes):
    rows = judge_urls(spark.createDataFrame([(*c, None, None, None) for c in captures], CAPTURES),
                      spark.createDataFrame(events, EVENTS), **sizes).collect()
    return sorted(((r.id, r.action, r.scope, r.value, r.kept) for r in rows), key=repr)


@pytest.mark.parametrize("slice_seconds", [1, 7, 1000])
def test_against_brute_force(spark, slice_seconds):
    rng = random.Random(slice_seconds)
    hosts = ["a.example.com", "b.example.com", "example.com", "other.org", "x.y.other.org"]
    entries = [("host", h) for h in hosts] + [("domain", "example.com"), ("domain", "org"),
                                              ("prefix", "other.org/a"), ("prefix", "other.org/a/b")]
    events = [(rng.choice("PQ"), *rng.choice(entries), rng.choice(["block", "allow"]),
               rng.randrange(60), rng.random() < 0.7) for _ in range(80)]
    captures = [(i, f"http://{rng.choice(hosts)}" + rng.choice(["", "/a", "/a/b/c?q=1", "/z#f", "?x=/a"]),
                 rng.randrange(70)) for i in range(150)]
    assert got(spark, captures, events, slice_seconds=slice_seconds) == brute(captures, events)


def test_edges(spark):
    events = [("L", "host", "h.com", "block", 10, True), ("L", "host", "h.com", "block", 10, True),
              ("L", "host", None, "block", 0, True), ("L", "host", "h.com", "block", 20, False),
              ("L", "host", "same.com", "block", 5, True), ("L", "host", "same.com", "block", 5, False)]
    captures = [(1, "http://H.com:80/x", 10), (2, "http://user@h.com/", 20), (3, None, 12), (4, "h.com", 12),
                (5, "http://h.com", None), (None, "http://h.com", 15), (1, "http://H.com:80/x", 10),
                (6, "http:///only/path", 12), (7, "http://h.com/" + "d/" * 5000, 19), (8, "http://same.com", 6)]
    assert got(spark, captures, events) == brute(captures, events)
    empty = spark.createDataFrame([], EVENTS)
    assert {r[-1] for r in got(spark, captures, [("L", "host", "no", "block", 1, True)])} == {True}
    assert judge_urls(spark.createDataFrame([], CAPTURES), empty).count() == 0
    assert judge_urls(spark.createDataFrame([(1, "http://a.b", 3, None, None, None)], CAPTURES),
                      empty).first().kept


def test_times_far_out(spark):
    """One capture or event in microseconds, or before all others, is a time like any other."""
    far = 1_700_000_000_000_000
    events = [("L", "host", "h.com", "block", 1_700_000_000, True), ("L", "domain", "h.com", "allow", 5, True),
              ("L", "domain", "h.com", "allow", 1_600_000_000, False), ("M", "host", "h.com", "block", far, True),
              ("M", "prefix", "h.com/x", "allow", -far, True), ("M", "host", "o.com", "block", 9, True)]
    captures = [(i, f"http://{host}{path}", at) for i, (host, path, at) in enumerate(
        (host, path, at) for host in ("h.com", "o.com") for path in ("", "/x/y")
        for at in (far, far + 1, far - 1, -far, -far - 1, 0, 1_650_000_000, 1_700_000_001, (1 << 62)))]
    assert got(spark, captures, events) == brute(captures, events)
    assert got(spark, captures, events, slice_seconds=1) == brute(captures, events)


def test_validity(spark):
    events = [("L", "host", "h", "block", 1, True), ("L", "host", "h", "allow", 50, True),
              ("L", "host", "h", "allow", 70, False), ("L", "host", "h", "block", 90, True)]
    found = validity(spark.createDataFrame(events, EVENTS), 10).collect()
    assert sorted((r.since, r.until, r.action) for r in found) == [
        (1, 50, "block"), (50, 70, "allow"), (90, None, "block")]
