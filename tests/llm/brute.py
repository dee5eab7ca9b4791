"""Plain Python versions that the operators must agree with."""

from __future__ import annotations

import hashlib
import re

import xxhash


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def repeats(texts: list[str | None], length: int) -> list[tuple]:
    """(bytes, removed, spans, hash of what is left) per text."""
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def normalised(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def simhash(text: str | None, width: int = 3) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(values: list[int], ids: list[int], budget: int) -> list[int]:
    """The least id reachable over values that differ in at most `budget` bits."""
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                root[a] = b
    least: dict[int, int] = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(values))]


def contamination(texts: list[str | None], items: list[tuple], width: int = 10) -> list[tuple]:
    """(words, hit words, items) per text."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1)) if w else []:
            windows.setdefault(tuple(w[i:i + width]), set()).add(str(item))
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if names := windows.get(tuple(w[i:i + size])):
                    hit.update(range(i, i + size))
                    found |= names
        out.append((len(w), hit, sorted(found)))
    return out


def mix(rows: list[tuple], weights: dict, block: int) -> dict:
    """{id: (slot, position)} for (id, source) rows by a slot-by-slot simulation."""
    queue: dict = {}
    for i, source in sorted(rows, key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[0])):
        queue.setdefault(source, []).append(i)
    h, got, place, out, slot = sum(weights.values()), dict.fromkeys(weights, 0), 0, {}, 0
    while len(out) < len(rows):
        ready = [s for s in sorted(weights) if got[s] * h // weights[s] <= slot]
        s = min(ready, key=lambda s: (-(-(got[s] + 1) * h // weights[s]), s))
        for i in queue.get(s, [])[got[s] * block:(got[s] + 1) * block]:
            out[i] = (slot, place)
            place += 1
        got[s] += 1
        slot += 1
    return out
