"""Phrase collocations from weighted acyclic automata.

Each task counts the phrases of one to three words in its share of the texts and builds automata of
them, cut at prefixes that are the same for all tasks. The automata of one range of prefixes come
together, are united, and their counts added. Candidates are scored by the counts of their parts, which
lie in other ranges: the parts wanted of a range form an automaton too, which is composed with the
range's counts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.llm import count_automata as automata
from ledgersift.llm.common import pieces, stage, utf8
from ledgersift.operators.numbering import number_rows
from ledgersift.operators.sizing import small_rows

MIN_COUNT = 10
MIN_SHARE = 50              # per cent of a phrase's count in a longer one that drops the phrase
FIRST = 2000                # phrases reported per language
NO_LANG = "und"
SHARD_TOKENS = 3_000_000    # words that a task counts at once
SLICE_BYTES = 4 << 20       # text that is split into words at once
RANGE_PHRASES = 2_000_000   # entries of all tasks' automata in one range of prefixes, about
SAMPLE = 64                 # one text in so many proposes where the ranges end
MAX_BOUNDS = 4_000_000      # ends of ranges, which go to every task
LOTS = 64                   # parts of a language's candidates that are ranked by themselves first
BATCH_BYTES = 8 << 20
BATCH_ROWS = 100_000

# A-Z are lower-cased; the bytes that end a piece become a full stop.
TABLE = bytes(ord(".") if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))

Bounds = dict[str, list[tuple[bytes, ...]]]


class Shard:
    """Words of one language as numbers in the order of their first use, 0 for the end of a piece."""

    def __init__(self, start: list[bytes] = ()):
        self.number = defaultdict(count(1).__next__, {b".": 0})
        self.runs: list[np.ndarray] = []
        self.tokens = 0
        self._take(list(start))

    def _take(self, tokens: list[bytes]) -> None:
        self.runs.append(np.fromiter(map(self.number.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
        self.tokens += len(tokens)

    def add(self, text: bytes) -> Iterator[automata.Phrases]:
        """Take a text; whenever the shard is full, its phrases come out and the next words start anew."""
        line = text.translate(TABLE).replace(b".", b" . ") + b" . "
        at = 0
        while at < len(line):
            end = line.find(b" ", at + SLICE_BYTES)
            end = len(line) if end < 0 else end
            self._take(line[at:end].split())
            at = end
            if self.tokens >= SHARD_TOKENS or len(self.number) >= automata.WORDS // 2:
                yield self.close(last=False)

    def close(self, last: bool = True) -> automata.Phrases:
        """The phrases so far. The last two words wait for those that follow, unless these are the last."""
        words = list(self.number)
        ends = np.zeros(2 if last else 0, dtype=np.int32)
        numbers = np.concatenate([*self.runs, ends])
        found = automata.all_phrases(words[1:], numbers)
        self.__init__([words[i] for i in numbers[-2:]])
        return found


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, automata.Phrases]]:
    """Phrases of the texts (lang, text as bytes), a shard of one language at a time."""
    shards: dict[str, Shard] = {}
    for batch in pieces(batches, BATCH_BYTES):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            by_lang.setdefault(lang, []).append(text.as_py())
        for lang, texts in by_lang.items():
            for found in shards.setdefault(lang, Shard()).add(b".".join(texts)):
                yield lang, found
        while sum(s.tokens for s in shards.values()) > SHARD_TOKENS:
            lang = max(shards, key=lambda k: shards[k].tokens)
            yield lang, shards.pop(lang).close()
    for lang, shard in shards.items():
        yield lang, shard.close()


def _cut(lang: str, found: automata.Phrases, bounds: Bounds) -> Iterator[tuple[str, int, automata.Phrases]]:
    """The parts of `found` in each range of prefixes of its language."""
    cuts = [0, *[found.place(b) for b in bounds.get(lang, [])], len(found.rows)]
    for place, (low, high) in enumerate(zip(cuts, cuts[1:])):
        if low < high:
            yield lang, place, found.part(low, high)


def _blocks(parts: Iterator[tuple[str, int, automata.Phrases]]) -> Iterator[pa.RecordBatch]:
    for lang, place, found in parts:
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([place], pa.int32()),
             pa.array([automata.to_bytes(automata.build(found))], pa.binary())], ["lang", "place", "block"])


BLOCK = "lang string, place int, block binary"


def range_bounds(texts: DataFrame, per_range: int = RANGE_PHRASES, sample: int = SAMPLE) -> Bounds:
    """Per language, the first phrases of all ranges but the first.

    They only balance the work: a sample of texts proposes them, by the entries of its own shards, so that
    a range holds at most about `per_range` entries of all shards. A frequent word's phrases may fill many
    ranges.
    """
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in _shards(batches):
            for at in range(0, len(found.rows), BATCH_ROWS):
                part = found.part(at, at + BATCH_ROWS).texts()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part, pa.string())], ["lang", "phrase"])

    chosen = texts.filter(F.pmod(F.xxhash64("text"), F.lit(sample)) == 0)
    phrases = chosen.mapInArrow(listed, "lang string, phrase string").select(
        "lang", F.split("phrase", " ").alias("phrase"))
    ends = number_rows(phrases, ["lang", "phrase"]).filter(
        (F.col("row_no") % max(1, per_range // sample) == 0) & (F.col("row_no") > 0))
    bounds: Bounds = {}
    for r in small_rows(ends.select("lang", "phrase"), "ranges of phrases", MAX_BOUNDS):
        bounds.setdefault(r["lang"], []).append(tuple(w.encode() for w in r["phrase"]))
    return {lang: sorted(set(found)) for lang, found in bounds.items()}


def phrase_counts(texts: DataFrame, bounds: Bounds, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, place, words, block): per range the united automaton of phrases that occur `min_count` times.

    `words` counts the occurrences of all words of the range, frequent or not. `texts` has (lang, text as
    bytes); no row is left out.
    """
    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks(p for lang, found in _shards(batches) for p in _cut(lang, found, bounds))

    def add_up(group: pa.Table) -> pa.Table:
        found = automata.union([_phrases(b) for b in group["block"]])
        single = found.rows[:, 1] == 0
        kept = found.counts >= min_count
        frequent = automata.Phrases(found.words, found.rows[kept], found.counts[kept])
        block = automata.to_bytes(automata.build(frequent.part(0, len(frequent.rows))))
        return pa.table({"lang": group["lang"][:1], "place": group["place"][:1],
                         "words": pa.array([int(found.counts[single].sum())], pa.int64()),
                         "block": pa.array([block], pa.binary())})

    return texts.mapInArrow(shard, BLOCK).groupBy("lang", "place").applyInArrow(
        add_up, "lang string, place int, words bigint, block binary")


def _phrases(block: pa.BinaryScalar) -> automata.Phrases:
    return automata.expand(automata.from_bytes(block.as_py()))


def _read(batch: pa.RecordBatch) -> Iterator[tuple[str, automata.Phrases]]:
    for lang, block in zip(batch.column(0).to_pylist(), batch.column(1)):
        yield lang, _phrases(block)


def candidate_cuts(counts: DataFrame) -> DataFrame:
    """(lang, phrase, size, k, first, rest, a): each candidate once per place where it can be cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, found in _read(batch):
                names = ["", *[w.decode() for w in found.words]]
                out = []
                for row, a in zip(found.rows.tolist(), found.counts.tolist()):
                    words = [names[i] for i in row if i]
                    for k in range(1, len(words)):
                        out.append((" ".join(words), len(words), k, " ".join(words[:k]), " ".join(words[k:]), a))
                if out:
                    phrase, size, k, first, rest, a = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(out)), pa.array(phrase), pa.array(size, pa.int32()),
                         pa.array(k, pa.int32()), pa.array(first), pa.array(rest), pa.array(a, pa.int64())],
                        ["lang", "phrase", "size", "k", "first", "rest", "a"])

    return counts.select("lang", "block").mapInArrow(
        run, "lang string, phrase string, size int, k int, first string, rest string, a bigint")


def part_counts(counts: DataFrame, bounds: Bounds) -> DataFrame:
    """(lang, part, f): the counts of all parts of candidates.

    The parts that a range's candidates ask for go to the ranges that hold them, as automata, and are
    composed with the counts there.
    """
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for lang, found in _read(batch):
                    long = found.rows[found.rows[:, 1] > 0]
                    none = np.zeros(len(long), dtype=np.int64)
                    third = long[:, 2]
                    rest = np.stack([long[:, 1], third, none], axis=1)
                    two = np.stack([long[:, 0], np.where(third > 0, long[:, 1], 0), none], axis=1)
                    last = np.stack([third, none, none], axis=1)[third > 0]
                    single = np.stack([long[:, 0], none, none], axis=1)
                    wanted = np.concatenate([rest, two, last, single])
                    asked = automata.union([automata.Phrases(
                        found.words, wanted, np.ones(len(wanted), dtype=np.int64))])
                    yield from _cut(lang, asked.part(0, len(asked.rows)), bounds)
        yield from _blocks(parts())

    def answer(held: pa.Table, asked: pa.Table) -> pa.Table:
        wanted = automata.union([_phrases(b) for b in asked["block"]])
        found = np.zeros(len(wanted.rows), dtype=np.int64)
        for block in held["block"]:     # one, as counts have one row per range
            found += automata.compose(automata.from_bytes(block.as_py()), wanted)
        lang = [x.as_py() for x in asked["lang"][:1]] * len(found)
        return pa.table({"lang": pa.array(lang, pa.string()), "part": pa.array(wanted.texts(), pa.string()),
                         "f": pa.array(found)})

    asked = counts.select("lang", "block").mapInArrow(ask, BLOCK)
    return counts.groupBy("lang", "place").cogroup(asked.groupBy("lang", "place")).applyInArrow(
        answer, "lang string, part string, f bigint")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 min_share: int = MIN_SHARE, first: int | None = FIRST,
                 per_range: int = RANGE_PHRASES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): phrases of two or three words by how firmly they hang together.

    Everything is counted per language over all texts, overlaps included; pieces end at . , ; : ! ? and
    line ends. `a`, `l` and `r` count the phrase and the two parts of its weakest cut, `n` all words.
    `score` is floor(1,000,000 a^2 / (l r)) at that cut, the first of equally weak ones. Phrases below
    `min_count` are no candidates; those with `min_share` per cent of their occurrences in one longer
    candidate are left out. Each language's `first` phrases are returned, by score and count falling, then
    by the bytes of the phrase; None gives all, ranked by one task per language.

    A null text is empty, a null language `und`. Texts without words, and empty tables, add nothing;
    repeated rows count as often as they stand there. Other columns are not read.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                        utf8(F.col(text_col)).alias("text"))
    bounds = range_bounds(texts, per_range)
    counts = stage(phrase_counts(texts, bounds, min_count), "phrase-counts")
    cuts = stage(candidate_cuts(counts), "phrase-cuts")
    parts = stage(part_counts(counts, bounds), "phrase-parts")
    left = parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    exact = "CAST({} AS decimal(16,0))"   # a count below 10^16, so that no product passes 38 digits
    score = F.expr(f"1000000 * {exact.format('a')} * {exact.format('a')} div "
                   f"({exact.format('l')} * {exact.format('r')})")
    weakest = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
               .groupBy("lang", "phrase", "size", "a")
               .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")))
    inner = cuts.filter("size = 3").select(
        "lang", F.when(F.col("k") == 1, F.col("rest")).otherwise(F.col("first")).alias("phrase"), "a")
    longer = inner.groupBy(F.col("lang").alias("i_lang"), F.col("phrase").alias("i_phrase")).agg(
        F.max("a").alias("longer"))
    alone = weakest.join(
        longer, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("i_phrase"))
        & (100 * F.col("longer") >= min_share * F.col("a")), "left_anti")
    totals = counts.groupBy(F.col("lang").alias("t_lang")).agg(F.sum("words").alias("n"))
    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    if first is not None:   # the first of each lot, so that no task ranks all of a language's candidates
        lots = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(LOTS))).orderBy(*order)
        alone = alone.withColumn("place", F.row_number().over(lots)).filter(F.col("place") <= first)
    ranked = alone.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    if first is not None:
        ranked = ranked.filter(F.col("rank") <= first)
    return ranked.join(totals, F.col("lang") == F.col("t_lang")).select(
        "lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"))
