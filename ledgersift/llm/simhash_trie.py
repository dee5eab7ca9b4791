"""SimHash near-duplicates by a self-join of the binary trie over fingerprints.

Pairs of trie nodes are visited together, each with the number of bits in which its two prefixes differ,
and given up as soon as that exceeds the budget. The visit begins at a depth where nodes hold few
fingerprints on average: there the node pairs within the budget are listed by flipping up to `budget`
bits of each node, which are all that a visit from the root would leave. Spark joins this table of node
pairs; those that are still crowded are opened some levels at a time, and the rest of the trie is visited
inside tasks, one pair of subtrees per group, where pairs beyond the budget are pruned bit by bit. Equal
fingerprints are one leaf, so a group of copies of any size costs one row. A task hands on a spanning
forest of the links it finds, never all pairs; the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import pieces, row_hash, stage, utf8, without_rows
from ledgersift.llm.components import connected_components

SHINGLE = 3
SEED = 42
BUDGET = 2            # most differing bits of a link
NODE_ROWS = 2048      # fingerprints below a node that a task visits in one go
STEP_BITS = 6         # levels by which a crowded node pair is opened
BATCH_BYTES = 32 << 20
FRONTIER = 1 << 18    # node pairs a task opens at once
LEAF_PAIRS = 16


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles, 0 without words, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
        return int(hashes[0])
    line = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    start = np.cumsum(size + 1) - size - 1
    first, last = start[:len(words) - width + 1], (start + size)[width - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(first.tolist(), last.tolist())],
                      dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = SHINGLE) -> DataFrame:
    """(_id, _row, _print): id, row hash and fingerprint of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            prints = np.array([fingerprint(t.as_py(), width) for t in batch.column(2)],
                              dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints)], ["_id", "_row", "_print"])

    rows = docs.select(F.col(id_col).alias("_id"), row_hash(F.col(text_col)).alias("_row"),
                       utf8(F.col(text_col)).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, _row bigint, _print bigint")


def _unsigned(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, dtype=np.int64).view(np.uint64)


def visit(a: np.ndarray, b: np.ndarray, same: bool, depth: int, budget: int) -> Iterator[tuple]:
    """Index arrays (i, j) of linked entries of two sorted arrays that each share `depth` bits.

    `same` says that both are the same node; then each pair comes once.
    """
    differ = 0
    if not same and depth:
        differ = int((int(a[0]) ^ int(b[0])) >> (64 - depth)).bit_count()
    todo = [(depth, np.array([[0, len(a), 0, len(b), differ, int(same)]], dtype=np.int64))]
    while todo:
        depth, pairs = todo.pop()
        if len(pairs) > FRONTIER:
            todo += [(depth, pairs[FRONTIER:]), (depth, pairs[:FRONTIER])]
            continue
        a0, a1, b0, b1, bits, one = pairs.T
        leaf = ((a1 - a0) * (b1 - b0) <= LEAF_PAIRS) | (depth == 64)
        if leaf.any():
            yield from _leaves(a, b, pairs[leaf], budget)
        pairs = pairs[~leaf]
        if not len(pairs):
            continue
        a0, a1, b0, b1, bits, one = pairs.T
        a_cut = _cut(a, a0, a1, depth)
        b_cut = np.where(one == 1, a_cut, _cut(b, b0, b1, depth))
        zero = np.zeros_like(one)
        children = np.concatenate([
            np.stack([a0, a_cut, b0, b_cut, bits, one], axis=1),
            np.stack([a_cut, a1, b_cut, b1, bits, one], axis=1),
            np.stack([a0, a_cut, b_cut, b1, bits + 1, zero], axis=1),
            np.stack([a_cut, a1, b0, b_cut, bits + 1, zero], axis=1)[one == 0]])
        alive = ((children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3])
                 & (children[:, 4] <= budget))
        if alive.any():
            todo.append((depth + 1, children[alive]))


def _cut(values: np.ndarray, start: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """Where the entries of each node with the next bit set begin."""
    shift = np.uint64(63 - depth)
    bound = ((values[start] >> shift) | np.uint64(1)) << shift
    return np.clip(np.searchsorted(values, bound, side="left"), start, end)


def _leaves(a: np.ndarray, b: np.ndarray, pairs: np.ndarray, budget: int) -> Iterator[tuple]:
    a0, a1, b0, b1, _, one = pairs.T
    high = b1 - b0
    count = (a1 - a0) * high
    pair = np.repeat(np.arange(len(pairs)), count)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
    i, j = a0[pair] + at // high[pair], b0[pair] + at % high[pair]
    linked = (np.bitwise_count(a[i] ^ b[j]) <= budget) & ((one[pair] == 0) | (i < j))
    if linked.any():
        yield i[linked], j[linked]


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of linked entries; labels are the least index of a set once settled."""
    while len(i):
        low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        open_ = low != high
        i, j, low, high = i[open_], j[open_], low[open_], high[open_]
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _forest(group: pd.DataFrame, budget: int) -> pd.DataFrame:
    """(a, b): a spanning forest of the links between the two nodes of one group."""
    depth, same = int(group["depth"].iloc[0]), bool((group["node_a"] == group["node_b"]).iloc[0])
    left = np.sort(_unsigned(group.loc[group["side"] == 0, "_print"].to_numpy()))
    right = left if same else np.sort(_unsigned(group.loc[group["side"] == 1, "_print"].to_numpy()))
    every = left if same else np.concatenate([left, right])
    label = np.arange(len(every))
    for i, j in visit(left, right, same, depth, budget):
        _merge(label, i, j if same else j + len(left))
    child = np.flatnonzero(label != np.arange(len(label)))
    signed = every.view(np.int64)
    return pd.DataFrame({"a": signed[child], "b": signed[label[child]]})


def _nodes(prints: DataFrame, depth: int) -> DataFrame:
    return prints.groupBy(_node(depth).alias("node")).agg(F.count(F.lit(1)).alias("held"))


def _node(depth: int):
    return F.shiftrightunsigned("_print", 64 - depth) if depth else F.lit(0).cast("bigint")


def node_pairs(prints: DataFrame, budget: int = BUDGET, node_rows: int = NODE_ROWS) -> list:
    """[(depth, (node_a, node_b) table)]: pairs of nodes within the budget that tasks then visit."""
    depth = max(0, (prints.count() // node_rows).bit_length())
    nodes = _nodes(prints, depth)
    masks = [0] + [1 << i for i in range(depth)]
    if budget >= 2:
        masks += [1 << i | 1 << j for i in range(depth) for j in range(i)]
    for _ in range(3, budget + 1):  # further bits, for larger budgets
        masks = sorted({m | 1 << i for m in masks for i in range(depth)} | set(masks))
    other = nodes.select(F.col("node").alias("node_b"), F.col("held").alias("held_b"))
    pairs = stage(
        nodes.select(F.col("node").alias("node_a"), F.col("held").alias("held_a"),
                     F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])).alias("mask"))
        .withColumn("node_b", F.col("node_a").bitwiseXOR(F.col("mask")))
        .filter("node_a <= node_b").join(other, "node_b")
        .select("node_a", "node_b", "held_a", "held_b"), "trie-pairs")
    found = []
    crowded = (F.col("held_a") > 2 * node_rows) | (F.col("held_b") > 2 * node_rows)
    while True:
        step = min(STEP_BITS, 64 - depth)
        found.append((depth, pairs.filter(~crowded) if step else pairs))
        if not step or pairs.filter(crowded).isEmpty():
            return found
        depth += step
        below = _nodes(prints, depth)

        def children(side: str):
            return below.select(F.shiftrightunsigned("node", step).alias(f"up_{side}"),
                                F.col("node").alias(f"to_{side}"), F.col("held").alias(f"n_{side}"))

        opened = pairs.filter(crowded)
        pairs = stage(
            opened.join(children("a"), F.col("node_a") == F.col("up_a"))
            .join(children("b"), F.col("node_b") == F.col("up_b"))
            .filter((F.col("to_a") <= F.col("to_b"))
                    & (F.bit_count(F.col("to_a").bitwiseXOR(F.col("to_b"))) <= budget))
            .select(F.col("to_a").alias("node_a"), F.col("to_b").alias("node_b"),
                    F.col("n_a").alias("held_a"), F.col("n_b").alias("held_b")), "trie-pairs")


def trie_links(prints: DataFrame, budget: int = BUDGET, node_rows: int = NODE_ROWS) -> DataFrame:
    """(a, b): links of distinct fingerprints (`_print`) that keep all components of all links."""
    visits = None
    for depth, pairs in node_pairs(prints, budget, node_rows):
        keyed = prints.select("_print", _node(depth).alias("node"))
        sides = []
        for side, col in enumerate(("node_a", "node_b")):
            mine = pairs if side == 0 else pairs.filter("node_a < node_b")
            sides.append(keyed.join(mine, F.col("node") == F.col(col)).select(
                F.lit(depth).alias("depth"), "node_a", "node_b", F.lit(side).alias("side"),
                "_print"))
        both = sides[0].unionByName(sides[1])
        visits = both if visits is None else visits.unionByName(both)
    return visits.groupBy("depth", "node_a", "node_b").applyInPandas(
        lambda group: _forest(group, budget), "a bigint, b bigint")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = SHINGLE, budget: int = BUDGET,
                       node_rows: int = NODE_ROWS) -> DataFrame:
    """(_id, _row, _print, component_id): one row per input row.

    `component_id` is the smallest id that links of at most `budget` differing bits reach. A null or
    wordless text has fingerprint 0 and links like any other. Rows that repeat an id or a text are
    rows of their own. A component whose ids are all null has a null `component_id`. Other columns are
    not read; an empty table gives no rows.
    """
    signed = stage(fingerprints(docs, id_col, text_col, width), "simhash")
    prints = stage(signed.groupBy("_print").agg(F.min("_id").alias("_least")), "simhash-distinct")
    root = connected_components(trie_links(prints.select("_print"), budget, node_rows))
    placed = prints.join(root, F.col("_print") == F.col("node"), "left").select(
        "_print", "_least", F.coalesce("root", "_print").alias("root"))
    least = placed.groupBy("root").agg(F.min("_least").alias("component_id"))
    names = placed.select(F.col("_print").alias("_p"), "root").join(least, "root").select(
        "_p", "component_id")
    return signed.join(names, F.col("_print") == F.col("_p")).select(
        "_id", "_row", "_print", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one document of each component, the one with the smallest id; all columns stay.

    Rows that repeat that id stay with it; rows without an id go if their component has one with.
    """
    rows = simhash_components(docs, id_col, text_col)
    gone = rows.filter(~F.col("_id").eqNullSafe(F.col("component_id"))).select("_id", "_row")
    return without_rows(docs, gone, id_col, text_col)
