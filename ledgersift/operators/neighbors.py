"""Exact k nearest neighbours within one table, without comparing all pairs.

Equal rows are one point with a number of copies: their numbers follow each other, so copies of a point
cost nothing however many there are. Points are cut into leaves by recursive medians over all features,
learned from a bounded sample, and each leaf into blocks by medians that a task of its own learns from a
sample of the leaf, so blocks stay small however many points there are; the cuts do not touch the answer.
Step one finds each point's nearest in its own block, which bounds how far the true neighbours can be.
Step two descends the tree of the leaves' bounding boxes, then the boxes of the blocks of those leaves,
and visits only blocks that may hold a nearer or equally near row. Ties go to the lower row number,
whatever the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.operators.sizing import small_rows
from ledgersift.session import ensure_checkpoint_dir

BLOCK_ROWS = 2048
SAMPLE = 65_536        # points from which the cuts are learned
LEAF_SAMPLE = 16       # sampled points per leaf or block, at least
PLACED = 200_000       # points of a leaf that are put into its blocks in one piece
VISITS = 16_384        # visiting points handled in one piece
STEP = 256             # points compared at once, bounds the distance matrix
PAIRS = 1_000_000      # point-node pairs tested at once


def _cuts(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, value) of each inner node of a complete tree, root first; children at 2i+1, 2i+2."""
    feature = np.zeros((1 << depth) - 1, dtype=np.int64)
    value = np.zeros((1 << depth) - 1)
    held = {0: points}
    for node in range(len(feature)):
        part = held.pop(node)
        if len(part):
            feature[node] = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            at = part[:, feature[node]]
            value[node] = np.median(at)
            if value[node] == at.max() > at.min():      # more than half at the top: cut below it
                value[node] = at[at < at.max()].max()
        left = part[:, feature[node]] <= value[node] if len(part) else np.zeros(0, dtype=bool)
        held[2 * node + 1], held[2 * node + 2] = part[left], part[~left]
    return feature, value


def _leaf_of(points: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), dtype=np.int64)
    while len(feature) and len(node) and node[0] < len(feature):
        at = points[np.arange(len(points)), feature[node]]
        node = 2 * node + 1 + (at > value[node])
    return node - len(feature)


def _nearest(queries: np.ndarray, query_no: np.ndarray, members: np.ndarray, member_no: np.ndarray,
             copies: np.ndarray, k: int) -> tuple[list, list]:
    """Distances and row numbers of the k rows nearest to each query, its own point left out."""
    by_number = np.argsort(member_no)   # a stable sort by distance then settles ties by row number
    members, member_no, copies = members[by_number], member_no[by_number], copies[by_number]
    held = np.minimum(copies, k)
    dist, near = [], []
    for at in range(0, len(queries), STEP):
        part = queries[at:at + STEP]
        d = np.zeros((len(part), len(members)))
        for j in range(members.shape[1]):
            d += (part[:, j, None] - members[None, :, j]) ** 2
        d[query_no[at:at + STEP, None] == member_no[None, :]] = np.inf
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        found = np.sqrt(np.take_along_axis(d, order, axis=1))
        for row, far in zip(order, found):
            row, far = row[far < np.inf], far[far < np.inf]
            times = held[row]
            within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            number = np.repeat(member_no[row], times) + within
            far = np.repeat(far, times)
            best = np.lexsort((number, far))[:k]
            dist.append(far[best])
            near.append(number[best])
    return dist, near


def _lists(numbers: np.ndarray, dist: list, near: list, **more) -> pd.DataFrame:
    return pd.DataFrame({"first_no": numbers, "dist": pd.Series(dist, dtype=object),
                         "near": pd.Series(near, dtype=object), **more})


def nearest_neighbors(numbered: DataFrame, features: list[str], k: int,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(row_no, pick, near_no, distance): pick 0..k-1 from nearest to farthest.

    `numbered` has `row_no` 0.. following the order of the features, so equal rows are neighbours.
    """
    spark = numbered.sparkSession
    ensure_checkpoint_dir(spark)
    points = numbered.groupBy(*features).agg(
        F.min("row_no").alias("first_no"), F.count(F.lit(1)).alias("copies")).checkpoint()
    placed = _placed(points, features, block_rows)
    plain = ", ".join(f"`{f}` double" for f in features)

    def own_block(pdf: pd.DataFrame) -> pd.DataFrame:
        at, numbers = pdf[features].to_numpy(float), pdf["first_no"].to_numpy()
        dist, near = _nearest(at, numbers, at, numbers, pdf["copies"].to_numpy(), k)
        return _lists(numbers, dist, near, copies=pdf["copies"].to_numpy(), leaf=pdf["leaf"].to_numpy(),
                      piece=pdf["piece"].to_numpy(), **{f: pdf[f].to_numpy() for f in features})

    own = placed.groupBy("leaf", "piece").applyInPandas(
        own_block, "first_no bigint, dist array<double>, near array<bigint>, copies bigint, "
                   f"leaf bigint, piece bigint, {plain}").checkpoint()
    found = own.select("first_no", "dist", "near").unionByName(
        _visited(_visits(own, placed, features, k), placed, features, k))
    return _ranked(found, points, k)


def _placed(points: DataFrame, features: list[str], block_rows: int) -> DataFrame:
    """`points` with `leaf` and, within it, `piece`: together the block of a point."""
    count = points.count()
    sample = np.array([tuple(r) for r in points.select(*features, "first_no").orderBy(
        F.xxhash64("first_no")).limit(min(SAMPLE, count)).drop("first_no").collect()], dtype=float)
    leaves = max(1, min(-(-count // block_rows), len(sample) // LEAF_SAMPLE))
    feature, value = _cuts(sample.reshape(-1, len(features)), (leaves - 1).bit_length())

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(leaf=_leaf_of(pdf[features].to_numpy(float), feature, value))

    plain = ", ".join(f"`{f}` double" for f in features)
    located = points.mapInPandas(place, f"{plain}, first_no bigint, copies bigint, leaf bigint").checkpoint()
    return _blocked(located, features, block_rows).checkpoint()


def _blocked(located: DataFrame, features: list[str], block_rows: int) -> DataFrame:
    """The second level of cuts: every leaf learns its own from a sample and deals its points to them."""
    plain = ", ".join(f"`{f}` double" for f in features)
    # at most SAMPLE / LEAF_SAMPLE leaves
    sizes = F.broadcast(located.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")))
    sized = located.join(sizes, "leaf")

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        at = pdf[features].to_numpy(float)
        blocks = max(1, min(-(-int(pdf["size"].iloc[0]) // block_rows), len(at) // LEAF_SAMPLE))
        feature, value = _cuts(at, (blocks - 1).bit_length())
        return pd.DataFrame({"leaf": pdf["leaf"].iloc[:1], "feature": [feature], "value": [value]})

    chosen = F.pmod(F.xxhash64("first_no"), F.col("size")) < SAMPLE
    cuts = sized.filter(chosen).groupBy("leaf").applyInPandas(
        learn, "leaf bigint, feature array<bigint>, value array<double>")
    shares = F.ceil(F.col("size") / PLACED).cast("int")
    rows = sized.withColumn("share", F.pmod(F.hash("first_no"), shares)).drop("size")
    plans = cuts.join(sizes, "leaf").select(
        "leaf", "feature", "value", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))

    def place(pdf: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
        # a leaf without a sampled point has no plan and is one block
        feature, value = (np.asarray(plan[c].iloc[0]) if len(plan) else np.zeros(0) for c in ("feature", "value"))
        found = _leaf_of(pdf[features].to_numpy(float), feature.astype(np.int64), value)
        return pdf.drop(columns="share").assign(piece=found)

    return rows.groupBy("leaf", "share").cogroup(plans.groupBy("leaf", "share")).applyInPandas(
        place, f"leaf bigint, {plain}, first_no bigint, copies bigint, piece bigint")


def _visits(own: DataFrame, placed: DataFrame, features: list[str], k: int) -> DataFrame:
    """(first_no, leaf, piece, features...): blocks that may hold a nearer row than those found."""
    d = len(features)
    box = [*[F.min(f).alias(f"lo_{f}") for f in features], *[F.max(f).alias(f"hi_{f}") for f in features]]
    blocks = placed.groupBy("leaf", "piece").agg(*box).checkpoint()
    rows = small_rows(placed.groupBy("leaf").agg(*box, F.max("piece").alias("last")), "leaves")
    leaves = 1 << (max(r["leaf"] for r in rows)).bit_length() if rows else 1
    lo, hi = np.full((2 * leaves - 1, d), np.inf), np.full((2 * leaves - 1, d), -np.inf)
    last = np.full(leaves, -1)
    for r in rows:
        lo[leaves - 1 + r["leaf"]], hi[leaves - 1 + r["leaf"]] = r[1:1 + d], r[1 + d:1 + 2 * d]
        last[r["leaf"]] = r["last"]
    for node in range(leaves - 2, -1, -1):
        lo[node] = np.minimum(lo[2 * node + 1], lo[2 * node + 2])
        hi[node] = np.maximum(hi[2 * node + 1], hi[2 * node + 2])

    def gaps(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Distance of each point to its box, summed feature by feature as distances of points are."""
        gap = np.zeros(len(at))
        for j in range(d):
            gap += np.maximum(0.0, np.maximum(low[:, j] - at[:, j], at[:, j] - high[:, j])) ** 2
        return np.sqrt(gap)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at, numbers = pdf[features].to_numpy(float), pdf["first_no"].to_numpy()
            missing = k - (pdf["copies"].to_numpy() - 1)   # the copies themselves come first
            reach = np.array([x[m - 1] if len(x) >= m else np.inf
                              for x, m in zip(pdf["dist"], np.clip(missing, 1, k))])
            own_leaf, own_piece = pdf["leaf"].to_numpy(), pdf["piece"].to_numpy()
            todo = [(np.flatnonzero(missing > 0), np.zeros(int((missing > 0).sum()), dtype=np.int64))]
            while todo:
                point, node = todo.pop()
                if len(point) > PAIRS:
                    half = len(point) // 2
                    todo += [(point[:half], node[:half]), (point[half:], node[half:])]
                    continue
                near = gaps(at[point], lo[node], hi[node]) <= reach[point]
                point, node = point[near], node[near]
                inner = node < leaves - 1
                if inner.any():
                    todo.append((np.concatenate([point[inner]] * 2),
                                 np.concatenate([2 * node[inner] + 1, 2 * node[inner] + 2])))
                point, leaf = point[~inner], node[~inner] - (leaves - 1)
                other = (leaf != own_leaf[point]) | (last[leaf] > 0)
                point, leaf = point[other], leaf[other]
                if len(point):
                    mine = np.where(leaf == own_leaf[point], own_piece[point], -1)
                    yield pd.DataFrame({"first_no": numbers[point], "leaf": leaf, "mine": mine,
                                        "reach": reach[point], **{f: at[point, j] for j, f in enumerate(features)}})

    plain = ", ".join(f"`{f}` double" for f in features)
    calls = own.select("first_no", "dist", "copies", "leaf", "piece", *features).mapInPandas(
        probe, f"first_no bigint, leaf bigint, mine bigint, reach double, {plain}").checkpoint()
    load = calls.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / VISITS).cast("int").alias("shares"))
    load = F.broadcast(load)    # at most as many rows as there are leaves
    guests = calls.join(load, "leaf").withColumn("share", F.pmod(F.hash("first_no"), F.col("shares"))).drop("shares")
    hosts = blocks.join(load, "leaf").withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")

    def choose(asking: pd.DataFrame, boxes: pd.DataFrame) -> pd.DataFrame:
        at, reach, mine = asking[features].to_numpy(float), asking["reach"].to_numpy(), asking["mine"].to_numpy()
        low = boxes[[f"lo_{f}" for f in features]].to_numpy(float)
        high = boxes[[f"hi_{f}" for f in features]].to_numpy(float)
        found = []
        for b, piece in enumerate(boxes["piece"].to_numpy()):
            near = gaps(at, low[b:b + 1], high[b:b + 1]) <= reach
            point = np.flatnonzero(near & (mine != piece))
            if len(point):
                found.append(asking.iloc[point][["first_no", "leaf", *features]].assign(piece=piece))
        names = ["first_no", "leaf", "piece", *features]
        return (pd.concat(found) if found else asking.iloc[:0].assign(piece=0))[names]

    return guests.groupBy("leaf", "share").cogroup(hosts.groupBy("leaf", "share")).applyInPandas(
        choose, f"first_no bigint, leaf bigint, piece bigint, {plain}").checkpoint()


def _visited(visits: DataFrame, placed: DataFrame, features: list[str], k: int) -> DataFrame:
    """Nearest members of each visited block; a block with many visitors is split into shares."""
    load = visits.groupBy("leaf", "piece").agg(
        F.ceil(F.count(F.lit(1)) / VISITS).cast("int").alias("shares"))
    guests = visits.join(load, ["leaf", "piece"]).withColumn(
        "share", F.pmod(F.hash("first_no"), F.col("shares"))).drop("shares")
    hosts = placed.join(load, ["leaf", "piece"]).withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")

    def search(asking: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        numbers = asking["first_no"].to_numpy()
        dist, near = _nearest(asking[features].to_numpy(float), numbers, block[features].to_numpy(float),
                              block["first_no"].to_numpy(), block["copies"].to_numpy(), k)
        return _lists(numbers, dist, near)

    keys = ["leaf", "piece", "share"]
    return guests.groupBy(*keys).cogroup(hosts.groupBy(*keys)).applyInPandas(
        search, "first_no bigint, dist array<double>, near array<bigint>")


def _ranked(found: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """The k nearest of each row: copies of its own point first, then what the blocks gave."""
    entries = F.arrays_zip(F.col("dist").alias("dist"), F.col("near").alias("near"))
    order = Window.partitionBy("first_no").orderBy("e.dist", "e.near")
    best = (found.select("first_no", F.explode(entries).alias("e"))
            .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
            .groupBy("first_no").agg(F.array_sort(F.collect_list("e")).alias("others")))
    rows = points.select("first_no", "copies").join(best, "first_no", "left").select(
        "first_no", "copies", F.coalesce("others", F.array().cast(
            "array<struct<dist: double, near: bigint>>")).alias("others"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(k), F.col("copies") - 1))
    own = F.transform(F.filter(numbers, lambda i: i != F.col("copy")), lambda i: F.struct(
        F.lit(0.0).alias("dist"), (F.col("first_no") + i).alias("near")))
    nearest = F.slice(F.array_sort(F.concat(own, "others")), 1, k)
    return rows.select((F.col("first_no") + F.col("copy")).alias("row_no"),
                       F.posexplode(nearest).alias("pick", "e")).select(
        "row_no", "pick", F.col("e.near").alias("near_no"), F.col("e.dist").alias("distance"))
