"""Removal of long repeated byte strings with a threshold-bounded suffix structure.

Every window of `length` bytes belongs to the least-hashed seed (`SEED_BYTES` bytes) inside it, so two
equal windows belong to equal seeds. Consecutive windows of one seed form a segment. Segments whose
seed occurs once cannot hold a repeat and are left out by a count; equal segments are one class with a
number of copies. The classes that are left meet by seed. There a Burrows-Wheeler transform of their
texts is built, sorted as far as the threshold asks, and intervals of equal prefixes are extended
backwards, breadth first: the common prefix of each pair of neighbours is found in the order of its
value, and the expansion stops at `length`. Neighbours without a value by then share a window.

Segments that share a seed with no other class are joined to contiguous text first, so that each byte
enters the transform about once. A seed whose classes are too many for a task is settled window by
window through their 128-bit hashes, which Spark counts with map-side combining.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import pieces, row_hash, stage, stage_keys, utf8

LENGTH = 400
SEED_BYTES = 128
BATCH_BYTES = 4 << 20
CHUNK_BYTES = 2 << 20      # text that one transform holds
CROWD_BYTES = 4 << 20      # class text of one seed that a task takes at once

BASE = 0x9E3779B97F4A7C15
PLACE_BITS = np.uint64(28)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _seed_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` bytes from each place on; equal bytes have equal hashes."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, n), out=sums[1:])
    h = (sums[width:] - sums[:-width]) * _powers(pow(BASE, -1, 1 << 64), n - width + 1)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours, by doubling."""
    out, span = x, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return out if span == width else np.minimum(out[:len(out) - (width - span)], out[width - span:])


def segments(texts: list[bytes], length: int, width: int) -> tuple:
    """(text number, start, windows, seed hash, seeds) of all segments; texts of `length` or more."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    hashes = _seed_hashes(data, width)
    # ordered by the hash's upper bits, then by place: the leftmost of equal seeds
    keys = (hashes & ~((np.uint64(1) << PLACE_BITS) - np.uint64(1))) | np.arange(
        len(hashes), dtype=np.uint64)
    place = (_sliding_min(keys, length - width + 1) & (
        (np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    inside = np.zeros(len(place) + 1, dtype=np.int32)
    np.add.at(inside, begin, 1)
    np.add.at(inside, begin + sizes - length + 1, -1)
    inside = np.cumsum(inside)[:-1] > 0
    seed = hashes[place]
    first = np.ones(len(place), dtype=bool)
    first[1:] = (seed[1:] != seed[:-1]) | ~inside[:-1]
    first[begin] = True
    moved = np.ones(len(place), dtype=bool)
    moved[1:] = place[1:] != place[:-1]
    starts = np.flatnonzero(first & inside)
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    ends = np.flatnonzero(last)
    seeds = np.add.reduceat((moved | first).astype(np.int64), starts)
    text_of = np.searchsorted(begin, starts, side="right") - 1
    return text_of, starts - begin[text_of], ends - starts + 1, seed[starts].view(np.int64), seeds


def _groups(batch: pa.RecordBatch, column: int, least: int) -> Iterator[list]:
    """Row numbers with a text of `least` bytes or more, about a batch's worth of bytes at a time."""
    rows, held = [], 0
    for i, text in enumerate(batch.column(column)):
        value = text.as_py()
        if len(value) >= least:
            rows.append((i, value))
            held += len(value)
            if held >= BATCH_BYTES:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def occurrences(docs: DataFrame, length: int, width: int) -> DataFrame:
    """(id, row, seed, digest, start, windows, seeds): all segments of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            for rows in _groups(batch, 2, length):
                texts = [t for _, t in rows]
                text_of, start, windows, seed, seeds = segments(texts, length, width)
                digest = np.array([
                    xxhash.xxh3_64_intdigest(texts[t][a:a + w + length - 1]) for t, a, w in zip(
                        text_of.tolist(), start.tolist(), windows.tolist())], dtype=np.uint64)
                take = pa.array(np.array([i for i, _ in rows])[text_of])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(seed),
                     pa.array(digest.view(np.int64)), pa.array(start.astype(np.int32)),
                     pa.array(windows.astype(np.int32)), pa.array(seeds.astype(np.int32))],
                    ["id", "row", "seed", "digest", "start", "windows", "seeds"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "row", "text").mapInArrow(
        run, f"id {kind}, row bigint, seed bigint, digest bigint, start int, windows int, seeds int")


def bounded_order(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the cyclic text ordered by at least their first `depth` bytes, and 8-byte keys."""
    n = len(data)
    wide = np.concatenate([data, np.resize(data, 8)])
    keys = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        keys = (keys << np.uint64(8)) | wide[k:k + n]
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(n, dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, dtype=np.int64)
    at = np.flatnonzero(new)
    rank[order] = np.repeat(at, np.diff(np.append(at, n)))
    span = 8
    while span < depth:
        follow = np.append(new[1:], True)
        todo = np.flatnonzero(~(new & follow))      # places in groups of two or more
        if not len(todo):
            break
        suffix = order[todo]
        group = rank[suffix]
        key = (group.astype(np.uint64) << np.uint64(32)) | rank[(suffix + span) % n].astype(np.uint64)
        inner = np.argsort(key)
        suffix, key = suffix[inner], key[inner]
        order[todo] = suffix
        fresh = np.ones(len(todo), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        new[todo] = fresh
        heads = np.flatnonzero(fresh)
        rank[suffix] = np.repeat(todo[heads], np.diff(np.append(heads, len(todo))))
        span *= 2
    return order, ordered


def common_prefixes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of suffixes, and for each place whether it shares `length` bytes with the one before.

    Values below eight bytes are read off the sort keys. From there on the intervals of equal prefixes
    are extended by one byte to the left per level; an end of an interval that has no value yet gets
    the level as the common prefix of the two suffixes there.
    """
    n = len(data)
    order, keys = bounded_order(data, length)
    value = np.full(n + 1, -1, dtype=np.int16)
    apart = keys[1:] ^ keys[:-1]
    early = np.full(n - 1, 7, dtype=np.int16)
    for k in range(1, 8):
        early -= apart >= np.uint64(1 << (8 * k))
    value[1:n] = np.where(apart > 0, np.minimum(early, length - 1), -1)
    value[0] = value[n] = 0
    if length <= 8:
        value[1:n][early >= length] = -1
        return order, value[:n] < 0
    before = data[order - 1]                        # the transform; place -1 wraps around
    by_byte = np.argsort(before, kind="stable")
    back = np.empty(n, dtype=np.int32)              # where the suffix longer by one byte stands
    back[by_byte] = np.arange(n, dtype=np.int32)
    sorted_bytes = before[by_byte]
    same = sorted_bytes[1:] == sorted_bytes[:-1]
    earlier = np.full(n, -1, dtype=np.int32)        # the last place before with the same byte
    earlier[by_byte[1:][same]] = by_byte[:-1][same]
    later = np.full(n, n, dtype=np.int32)
    later[by_byte[:-1][same]] = by_byte[1:][same]
    edge = np.flatnonzero((value >= 0) & (value <= 7))
    hi = np.flatnonzero(value == 7)
    lo = edge[np.searchsorted(edge, hi) - 1]
    for level in range(8, length):
        if not len(hi):
            break
        one = hi - lo == 1
        new_lo = [back[lo[one]].astype(np.int64)]
        new_hi = [new_lo[0] + 1]
        lo, hi = lo[~one], hi[~one]
        if len(lo):
            size = hi - lo
            which = np.repeat(np.arange(len(lo)), size)
            at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + lo[which]
            head = earlier[at] < lo[which]
            tail = later[at] >= hi[which]
            byte = before[at].astype(np.int64)
            name = which << 8 | byte
            left, right = at[head], at[tail]
            new_lo.append(back[left[np.argsort(name[head])]].astype(np.int64))
            new_hi.append(back[right[np.argsort(name[tail])]].astype(np.int64) + 1)
        lo, hi = np.concatenate(new_lo), np.concatenate(new_hi)
        fresh = value[hi] < 0
        lo, hi = lo[fresh], hi[fresh]
        value[hi] = level
    return order, value[:n] < 0


def repeated_windows(texts: list[bytes], copies: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each text, which of its windows occur twice or more.

    `copies[i]` has the number of occurrences that each window of text i stands for.
    """
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"\xff".join(texts) + b"\xff", dtype=np.uint8)
    begin = np.cumsum(sizes + 1) - sizes - 1
    order, joined = common_prefixes(data, length)
    shared = joined.copy()
    shared[:-1] |= joined[1:]
    of_place = np.zeros(len(data), dtype=bool)
    of_place[order] = shared
    return [of_place[b:b + len(c)] | (c > 1) for b, c in zip(begin.tolist(), copies)]


def _runs(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"a": int(a), "b": int(b)} for a, b in zip(edges[::2], edges[1::2])]


RESULT = "seed bigint, digest bigint, runs array<struct<a: int, b: int>>"
RESULT_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _result(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], RESULT_TYPE)], ["seed", "digest", "runs"])


def _expand(length: int):
    """Chunks of class texts -> the windows of each class that repeat."""
    def settle(held: list) -> pa.RecordBatch:
        texts = [text for text, _ in held]
        copies = [np.concatenate([np.full(c["windows"], c["n"]) for c in classes])
                  for _, classes in held]
        rows = []
        for (_, classes), flags in zip(held, repeated_windows(texts, copies, length)):
            at = 0
            for c in classes:
                runs = _runs(flags[at:at + c["windows"]])
                at += c["windows"]
                if runs:
                    rows.append((c["seed"], c["digest"], runs))
        return _result(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seed, last = [], 0, None, None
        for batch in pieces(batches, BATCH_BYTES):
            for key, text, classes in zip(batch.column(0).to_pylist(), batch.column(1),
                                          batch.column(2).to_pylist()):
                if size >= CHUNK_BYTES and key != seed:
                    yield settle(held)
                    held, size = [], 0
                name = (key, classes[0]["digest"], len(classes))
                if name == last:       # the same class from a repeated row
                    continue
                seed, last = key, name
                value = text.as_py()
                held.append((value, classes))
                size += len(value)
        if held:
            yield settle(held)

    return run


def _cut(length: int):
    """Documents with their classes -> texts for the transform, keyed by seed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            keys, texts, names = [], [], []
            for text, classes in zip(batch.column(0), batch.column(1).to_pylist()):
                value = text.as_py()
                row: list = []
                for c in sorted(classes, key=lambda c: c["start"]):
                    follows = row and row[-1]["start"] + row[-1]["windows"] == c["start"]
                    if row and not (follows and c["alone"] and row[-1]["alone"]
                                    and c["start"] - row[0]["start"] < CHUNK_BYTES):
                        texts.append(_text(value, row, length))
                        names.append(row)
                        row = []
                    row.append(c)
                if row:
                    texts.append(_text(value, row, length))
                    names.append(row)
            keys = [row[0]["seed"] for row in names]
            slim = [[{k: c[k] for k in ("seed", "digest", "windows", "n")} for c in row]
                    for row in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(texts, pa.binary()),
                 pa.array(slim, pa.list_(pa.struct([
                     ("seed", pa.int64()), ("digest", pa.int64()), ("windows", pa.int32()),
                     ("n", pa.int64())])))], ["seed", "text", "classes"])

    return run


def _text(value: bytes, row: list, length: int) -> bytes:
    return value[row[0]["start"]:row[-1]["start"] + row[-1]["windows"] + length - 1]


def _single(length: int):
    """Documents with crowded classes -> the hash of each of their windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            for text, classes in zip(batch.column(0), batch.column(1).to_pylist()):
                value = text.as_py()
                for c in classes:
                    for at in range(0, c["windows"], 8192):
                        n, a = min(8192, c["windows"] - at), c["start"] + at
                        window = [xxhash.xxh3_128_digest(value[i:i + length]) for i in range(a, a + n)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(window, pa.binary()), pa.array(np.full(n, c["seed"])),
                             pa.array(np.full(n, c["digest"])),
                             pa.array(np.arange(at, at + n, dtype=np.int32)),
                             pa.array(np.full(n, c["n"]))],
                            ["window", "seed", "digest", "offset", "n"])

    return run


def repeat_spans(docs: DataFrame, length: int = LENGTH, width: int = SEED_BYTES,
                 crowd_bytes: int = CROWD_BYTES) -> DataFrame:
    """(id, row, start, end): byte ranges covered by repeated windows, not yet joined.

    `docs` has (id, row, text), the text as bytes; a row that occurs twice counts twice.
    """
    width = min(width, length)
    found = stage(occurrences(docs, length, width), "segments")
    again = stage_keys(found.groupBy("seed").agg(F.sum("seeds").alias("all"))
                       .filter("all > 1").select("seed"), "segment-keys")
    likely = stage(found.join(again, "seed", "left_semi"), "segments-again")
    classes = likely.groupBy("seed", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "row", "start")).alias("at"),
        F.max("windows").alias("windows"), F.max("seeds").alias("inner"))
    crowds = classes.groupBy("seed").agg(
        F.count(F.lit(1)).alias("classes"),
        F.sum(F.col("windows") + (length - 1)).alias("bytes"))
    # a segment that holds its seed more than once is compared with itself, so it stays by itself
    named = stage(classes.join(crowds, "seed").select(
        F.col("at.id").alias("at_id"), F.col("at.row").alias("at_row"), "bytes", F.struct(
            "seed", "digest", F.col("at.start").alias("start"), "windows", "n",
            ((F.col("classes") == 1) & (F.col("inner") == 1)).alias("alone")).alias("class")),
        "segment-classes")

    def with_text(part: DataFrame) -> DataFrame:
        wanted = part.groupBy("at_id", "at_row").agg(F.collect_list("class").alias("classes"))
        return docs.join(wanted, docs["id"].eqNullSafe(wanted["at_id"])
                         & (docs["row"] == wanted["at_row"])).select("text", "classes")

    crowded = named.filter(F.col("bytes") > crowd_bytes)
    texts = with_text(named.filter(F.col("bytes") <= crowd_bytes)).mapInArrow(
        _cut(length), "seed bigint, text binary, classes array<struct<seed: bigint, "
                      "digest: bigint, windows: int, n: bigint>>")
    repeats = (texts.repartition("seed").sortWithinPartitions("seed", F.col("classes")[0]["digest"])
               .mapInArrow(_expand(length), RESULT)
               .select("seed", "digest", F.explode("runs").alias("run"))
               .select("seed", "digest", F.col("run.a").alias("a"), F.col("run.b").alias("b")))
    if not crowded.isEmpty():
        windows = with_text(crowded).mapInArrow(
            _single(length), "window binary, seed bigint, digest bigint, offset int, n bigint"
        ).distinct()
        twice = windows.groupBy("window").agg(F.sum("n").alias("all")).filter("all > 1")
        repeats = repeats.unionByName(windows.join(twice, "window", "left_semi").select(
            "seed", "digest", F.col("offset").alias("a"), (F.col("offset") + 1).alias("b")))
    return likely.join(repeats, ["seed", "digest"]).select(
        "id", "row", (F.col("start") + F.col("a")).alias("start"),
        (F.col("start") + F.col("b") + (length - 1)).alias("end"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, BATCH_BYTES):
        kept, spans = [], []
        for text, cuts in zip(batch.column(2), batch.column(3).to_pylist()):
            value, runs, at, left = text.as_py(), [], 0, []
            for c in cuts or []:
                if runs and c["start"] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], c["end"])
                else:
                    runs.append([c["start"], c["end"]])
            for a, b in runs:
                left.append(value[at:a])
                at = b
            kept.append(b"".join([*left, value[at:]]))
            spans.append([{"start": a, "end": b} for a, b in runs])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(kept, pa.binary()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
            ["id", "row", "text", "kept", "spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, width: int = SEED_BYTES,
                   crowd_bytes: int = CROWD_BYTES) -> DataFrame:
    """(id, row, text, kept, spans, kept_sha256): one row per input row, texts as bytes.

    Each byte covered by a string of `length` bytes that also starts anywhere else, in the same text or
    another, is removed; `spans` has the maximal removed ranges. Strings are judged on the input, so
    all copies go. A null text is an empty one; texts shorter than `length` stay whole. Rows that
    repeat each other are copies like any other. Ids may be null; other columns are not read; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), row_hash(F.col(text_col)).alias("row"),
                       utf8(F.col(text_col)).alias("text"))
    cuts = repeat_spans(rows, length, width, crowd_bytes).groupBy(
        F.col("id").alias("c_id"), F.col("row").alias("c_row")).agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("cuts"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.join(cuts, rows["id"].eqNullSafe(cuts["c_id"]) & (rows["row"] == cuts["c_row"]),
                     "left").select("id", "row", "text", "cuts").mapInArrow(
        _kept, f"id {kind}, row bigint, text binary, kept binary, "
               "spans array<struct<start: int, end: int>>, kept_sha256 string")
