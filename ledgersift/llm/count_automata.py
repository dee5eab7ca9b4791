"""Acyclic automata over words whose arcs carry counts.

A path of one to three words from the root is a phrase, and the weight of its last arc the phrase's count.
An automaton is built from sorted phrases: when the input leaves a prefix, the state behind that prefix
is complete and is looked up in a register by its arcs (word, count, next state), so equal states are kept
once. States are kept per depth as lists of arcs sorted by word.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

DEPTH = 3
BITS = 21                   # of a word's number in a packed phrase; three fit in a signed 64-bit number
WORDS = (1 << BITS) - 1     # the most words that a packed table may have
SEPARATOR = b" "            # never within a word
ARC = 24                    # bytes of an arc: word, count, next state


@dataclass
class Phrases:
    """Sorted phrases with counts: `words` in byte order, `rows` of word numbers from 1 (0: no word)."""

    words: list[bytes]
    rows: np.ndarray        # phrases x 3
    counts: np.ndarray

    def part(self, low: int, high: int) -> Phrases:
        """The phrases from `low` to `high`, with only their own words."""
        rows = self.rows[low:high]
        used = np.unique(rows)
        used = used[used > 0]
        number = np.zeros(len(self.words) + 1, dtype=np.int64)
        number[used] = np.arange(1, len(used) + 1)
        return Phrases([self.words[i - 1] for i in used], number[rows], self.counts[low:high])

    def place(self, bound: tuple[bytes, ...]) -> int:
        """How many phrases come before `bound`."""
        low, high = 0, len(self.rows)
        for depth, word in enumerate(bound):
            column = self.rows[low:high, depth]
            at = bisect_left(self.words, word)
            first = low + int(np.searchsorted(column, at + 1, "left"))
            if at == len(self.words) or self.words[at] != word:
                return first
            low, high = first, low + int(np.searchsorted(column, at + 1, "right"))
        return low

    def texts(self) -> list[str]:
        names = ["", *[w.decode() for w in self.words]]
        return [" ".join(names[i] for i in row if i) for row in self.rows.tolist()]


def _sorted_sums(rows: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order with the sums of their counts."""
    if not len(rows):
        return rows.reshape(0, DEPTH), counts
    if words <= WORDS:
        packed = (rows[:, 0] << (2 * BITS)) | (rows[:, 1] << BITS) | rows[:, 2]
        order = np.argsort(packed, kind="stable")
        packed = packed[order]
        fresh = np.concatenate([[True], packed[1:] != packed[:-1]])
    else:
        order = np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))
        fresh = np.concatenate([[True], (rows[order[1:]] != rows[order[:-1]]).any(axis=1)])
    starts = np.flatnonzero(fresh)
    return rows[order[starts]], np.add.reduceat(counts[order], starts)


def all_phrases(words: list[bytes], numbers: np.ndarray) -> Phrases:
    """Phrases of one to three words that start at each place of a run of word numbers; 0 is a break.

    The last two places only complete phrases before them. `words` may have any order.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.zeros(len(words) + 1, dtype=np.int64)
    rank[np.array(order, dtype=np.int64) + 1] = np.arange(1, len(words) + 1)
    ids = rank[numbers]
    first, second, third = ids[:-2], ids[1:-1], ids[2:]
    packed = (first << (2 * BITS)) | (second << BITS) | np.where(second > 0, third, 0)
    packed = np.sort(packed[first > 0])
    starts = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])) if len(packed) else packed
    packed, counts = packed[starts], np.diff(np.append(starts, len(packed)))
    keys, sums = [], []
    for depth in range(1, DEPTH + 1):      # a place counts for each phrase that starts there
        cut = packed >> (BITS * (DEPTH - depth))
        whole = (cut & WORDS) > 0
        cut, n = cut[whole], counts[whole]
        if len(cut):
            at = np.flatnonzero(np.concatenate([[True], cut[1:] != cut[:-1]]))
            keys.append(cut[at] << (BITS * (DEPTH - depth)))
            sums.append(np.add.reduceat(n, at))
    if not keys:
        return Phrases([], np.zeros((0, DEPTH), dtype=np.int64), np.zeros(0, dtype=np.int64))
    packed, counts = np.concatenate(keys), np.concatenate(sums)
    order_ = np.argsort(packed)
    packed = packed[order_]
    rows = np.stack([packed >> (2 * BITS), (packed >> BITS) & WORDS, packed & WORDS], axis=1)
    return Phrases([words[i] for i in order], rows, counts[order_])


@dataclass
class Automaton:
    """Per depth: arcs (word, count, next state) of all its states one after another, and where each begins."""

    words: list[bytes]
    arcs: list[np.ndarray]
    begins: list[np.ndarray]


def build(phrases: Phrases) -> Automaton:
    """The least automaton of sorted phrases; prefixes that are no phrase get arcs without count."""
    rows, counts = phrases.rows, phrases.counts
    size = (rows > 0).sum(axis=1)
    arcs, begins = [], []
    next_state = np.zeros(0, dtype=np.int64)
    for depth in range(DEPTH, 0, -1):
        deep = size >= depth
        part, length = rows[deep, :depth], size[deep]
        starts = _changes(part)
        paths = part[starts]
        weight = _sums(np.where(length == depth, counts[deep], 0), starts)
        following = np.zeros(len(paths), dtype=np.int64)            # state 0 has no arcs
        following[_sums(length > depth, starts) > 0] = next_state   # paths that go on, in order
        table = np.stack([paths[:, -1], weight, following], axis=1).astype("<i8")
        # one state per prefix: its arcs, looked up in the register once the prefix is left
        cuts = _changes(paths[:, :-1]) if depth > 1 else np.arange(min(1, len(paths)))
        ends = np.append(cuts[1:], len(table))[:len(cuts)]
        text, register = table.tobytes(), {} if depth == 1 else {b"": 0}
        next_state = np.array([register.setdefault(text[ARC * a:ARC * b], len(register))
                               for a, b in zip(cuts.tolist(), ends.tolist())], dtype=np.int64)
        sizes = [len(s) // ARC for s in register] or [0]
        arcs.insert(0, np.frombuffer(bytearray().join(register), dtype="<i8").reshape(-1, 3))
        begins.insert(0, np.concatenate([[0], np.cumsum(sizes)]))
    return Automaton(phrases.words, arcs, begins)


def _changes(rows: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before; the first row does."""
    if not len(rows):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    values = values.astype(np.int64)
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def expand(automaton: Automaton) -> Phrases:
    """All phrases with a count, in order."""
    found, counts = [], []
    paths = np.zeros((1, 0), dtype=np.int64)
    states = np.zeros(1, dtype=np.int64)
    for depth in range(DEPTH):
        begin = automaton.begins[depth]
        many = begin[states + 1] - begin[states]
        arc = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[states], many)
        word, n, states = automaton.arcs[depth][arc].T
        paths = np.concatenate([np.repeat(paths, many, axis=0), word[:, None]], axis=1)
        kept = n > 0
        rows = np.zeros((int(kept.sum()), DEPTH), dtype=np.int64)
        rows[:, :depth + 1] = paths[kept]
        found.append(rows)
        counts.append(n[kept])
        if depth + 1 < DEPTH:
            onward = states > 0
            paths, states = paths[onward], states[onward]
    rows, counts = _sorted_sums(np.concatenate(found), np.concatenate(counts), len(automaton.words))
    return Phrases(automaton.words, rows, counts)


def union(parts: list[Phrases]) -> Phrases:
    """Phrases of all parts; counts of equal ones are added."""
    words = sorted(set().union(*[p.words for p in parts]))
    number = {w: i + 1 for i, w in enumerate(words)}
    rows, counts = [np.zeros((0, DEPTH), dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for p in parts:
        rows.append(np.array([0, *[number[w] for w in p.words]], dtype=np.int64)[p.rows])
        counts.append(p.counts)
    return Phrases(words, *_sorted_sums(np.concatenate(rows), np.concatenate(counts), len(words)))


def compose(counts: Automaton, wanted: Phrases) -> np.ndarray:
    """The count of each wanted phrase: both are followed word by word, state by state; 0 where a path ends."""
    number = {w: i + 1 for i, w in enumerate(counts.words)}
    rows = np.array([0, *[number.get(w, -1) for w in wanted.words]], dtype=np.int64)[wanted.rows]
    state = np.zeros(len(rows), dtype=np.int64)
    alive = np.ones(len(rows), dtype=bool)
    found = np.zeros(len(rows), dtype=np.int64)
    width = len(counts.words) + 1
    for depth in range(DEPTH):
        arcs, begin = counts.arcs[depth], counts.begins[depth]
        here = np.flatnonzero(alive & (rows[:, depth] != 0))
        if not len(here) or not len(arcs):
            alive[here] = False
            found[here] = 0
            continue
        owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        index = owner * width + arcs[:, 0]
        key = state[here] * width + rows[here, depth]
        at = np.minimum(np.searchsorted(index, key), len(index) - 1)
        hit = (index[at] == key) & (rows[here, depth] > 0)
        found[here] = np.where(hit, arcs[at, 1], 0)
        state[here] = np.where(hit, arcs[at, 2], 0)
        alive[here] = hit
    return found


def _least(values: np.ndarray) -> np.ndarray:
    top = int(values.max(initial=0))
    return values.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if top < 1 << 8 * int(t[2])))


def to_bytes(automaton: Automaton) -> bytes:
    """Each array in the least width that holds it, compressed."""
    arrays = [_least(np.diff(b)) for b in automaton.begins]
    arrays += [_least(table[:, i]) for table in automaton.arcs for i in range(3)]
    text = SEPARATOR.join(automaton.words)
    head = np.array([[len(a), a.itemsize] for a in arrays] + [[len(text), len(automaton.words)]], dtype="<i8")
    raw = b"".join([head.tobytes(), *[a.tobytes() for a in arrays], text])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def from_bytes(data: bytes) -> Automaton:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    count = 4 * DEPTH + 1
    head = np.frombuffer(raw, dtype="<i8", count=2 * count).reshape(-1, 2).tolist()
    at, arrays = 16 * count, []
    for n, width in head[:-1]:
        arrays.append(np.frombuffer(raw, dtype=f"<u{width}", count=n, offset=at).astype(np.int64))
        at += n * width
    words = raw[at:at + head[-1][0]].split(SEPARATOR) if head[-1][1] else []
    begins = [np.concatenate([[0], np.cumsum(a)]) for a in arrays[:DEPTH]]
    arcs = [np.stack(arrays[DEPTH + 3 * d:DEPTH + 3 * d + 3], axis=1) for d in range(DEPTH)]
    return Automaton(words, arcs, begins)
