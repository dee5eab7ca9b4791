"""Mixing sources to target weights by Pfair scheduling.

Every source's rows are cut into blocks of equal size. A cycle has as many slots as the integer
weights add up to; block j of a source with weight a in a cycle of H slots may run from slot
floor(j*H/a) and must run before slot ceil((j+1)*H/a). Earliest deadline first fills the slots, which
keeps every source within one block of its share at every slot. At the end of a cycle all sources are
exactly even, so one cycle's schedule serves for all of them and a row's place follows by arithmetic:
no row waits for another.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.llm.common import stage
from ledgersift.operators.numbering import number_rows

CYCLE = 1000          # slots per cycle; weights are multiples of 1/CYCLE
SOURCE_SLOTS = 4      # slots per source in a cycle, where there are more than CYCLE sources
RUN = 4096            # blocks listed, or added up, in one piece
BLOCK_ROWS = 16
BUCKET_ROWS = 2048    # rows numbered in one piece


def source_key(source: Column) -> Column:
    """A key that is never null: null is a source of its own."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def root_weights(counts: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """(key, rows) -> (key, rows, weight): whole numbers that add up to `cycle`.

    Proportional to the root of the row count (so small sources are lifted), one at least, rounded by
    largest remainders in whole numbers. Fails if there are more sources than slots.
    """
    every = Window.partitionBy()
    root = counts.withColumn("_root", F.floor(F.sqrt("rows")).cast("bigint"))
    spread = root.withColumns({"_all": F.sum("_root").over(every),
                               "_spare": F.lit(cycle) - F.count(F.lit(1)).over(every)})
    refused = F.raise_error(F.lit("more sources than slots in a cycle")).cast("bigint")
    spare = F.when(F.col("_spare") < 0, refused).otherwise(F.col("_spare"))
    whole = spread.withColumn("_spare", spare).withColumns({
        "_base": F.expr("1 + _root * _spare div _all"),
        "_rest": F.expr("(_root * _spare) % _all")})
    left = F.lit(cycle) - F.sum("_base").over(every)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("_rest"), "key"))
    return (whole.withColumns({"_left": left, "_rank": rank})
            .select("key", "rows", (F.col("_base") + (F.col("_rank") <= F.col("_left"))
                                    .cast("bigint")).alias("weight")))


def cycle_schedule(weights: DataFrame) -> DataFrame:
    """(key, share, nth, slot, before, shares, sizes): one row per slot of the cycle.

    `share` is the source's weight, `nth` counts its blocks within the cycle. `before` has the blocks each source got in
    earlier slots, `shares` and `sizes` the weights and row counts, all in key order. The schedule is a
    fold over the slots; its size is the cycle, whatever the table's.
    """
    one = weights.filter("weight > 0").groupBy().agg(
        F.array_sort(F.collect_list(F.struct("key", "weight", "rows"))).alias("src"))
    one = one.selectExpr(
        "transform(src, x -> x.key) AS keys", "transform(src, x -> x.weight) AS shares",
        "transform(src, x -> x.rows) AS sizes",
        "aggregate(src, 0L, (s, x) -> s + x.weight) AS h").filter("h > 0")
    picked = one.selectExpr("*", """
        aggregate(
          sequence(0L, h - 1),
          named_struct('got', transform(shares, x -> 0L), 'order', CAST(array() AS array<int>)),
          (state, t) -> transform(
            array(array_min(transform(
              filter(sequence(0, size(shares) - 1), k -> state.got[k] < shares[k]
                     AND (state.got[k] * h) div shares[k] <= t),
              k -> named_struct('due', ((state.got[k] + 1) * h + shares[k] - 1) div shares[k],
                                'k', k))).k),
            p -> named_struct('got', transform(state.got, (g, k) -> if(k = p, g + 1, g)),
                              'order', concat(state.order, array(p))))[0],
          state -> state.order) AS picks""")
    slots = picked.select("keys", "shares", "sizes", "picks",
                          F.posexplode("picks").alias("slot", "k"))
    return slots.selectExpr(
        "keys[k] AS key", "CAST(slot AS bigint) AS slot",
        """transform(sequence(0, size(keys) - 1), s ->
             CAST(size(filter(slice(picks, 1, slot), p -> p = s)) AS bigint)) AS before""",
        "k", "shares", "sizes").selectExpr(
        "key", "shares[k] AS share", "before[k] AS nth", "slot", "before", "shares", "sizes")


def slot_order(weights: list[int]) -> Iterator[tuple[int, int, int]]:
    """(source, nth, slot) of a cycle: the order of `cycle_schedule`, with heaps for many sources."""
    h, slot = sum(weights), 0
    waiting, ready = [(0, k, 0) for k in range(len(weights))], []
    heapify(waiting)
    while waiting or ready:
        while waiting and waiting[0][0] <= slot:
            _, k, nth = heappop(waiting)
            heappush(ready, (-(-(nth + 1) * h // weights[k]), k, nth))
        _, k, nth = heappop(ready)
        yield k, nth, slot
        if nth + 1 < weights[k]:
            heappush(waiting, ((nth + 1) * h // weights[k], k, nth + 1))
        slot += 1


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches), pa.schema([("key", pa.string()), ("weight", pa.int64())]))
    keys, order = table.column("key").combine_chunks(), slot_order(table.column("weight").to_pylist())
    while piece := [x for x, _ in zip(order, range(65_536))]:
        k, nth, slot = (pa.array(c, pa.int64()) for c in zip(*piece))
        yield pa.RecordBatch.from_arrays([keys.take(k), nth, slot], ["s_key", "nth", "slot"])


def block_places(shares: DataFrame, block_rows: int) -> DataFrame:
    """(b_key, b_block, b_slot, b_start): slot of every block and the rows before it, for many sources.

    One task makes the cycle, a heap step per slot; blocks are numbered in order of slots over ranges.
    """
    shares = stage(shares, "mix-shares")
    h = shares.agg(F.sum("weight")).first()[0]
    slots = stage(shares.select("key", "weight").repartition(1).sortWithinPartitions("key").mapInArrow(
        _slots, "s_key string, nth bigint, slot bigint"), "mix-slots")
    blocks = (shares.selectExpr("*", f"explode(sequence(0L, (rows - 1) div {block_rows * RUN})) AS run")
              .selectExpr("*", f"""explode(sequence(run * {RUN}, least((run + 1) * {RUN},
                  (rows + {block_rows - 1}) div {block_rows}) - 1)) AS b_block""")
              .selectExpr("key AS b_key", "b_block", "b_block % weight AS turn", "b_block div weight AS round",
                          f"least({block_rows}L, rows - b_block * {block_rows}) AS size"))
    placed = blocks.join(slots, (F.col("b_key") == F.col("s_key")) & (F.col("turn") == F.col("nth"))).select(
        "b_key", "b_block", "size", (F.col("round") * h + F.col("slot")).alias("b_slot"))
    lined = stage(number_rows(placed, ["b_slot"]).withColumn("run", F.expr(f"row_no div {RUN}")), "mix-blocks")
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = lined.groupBy(F.col("run").alias("r_run")).agg(F.sum("size").alias("rows")).withColumnRenamed(
        "r_run", "run").select("run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("run").orderBy("row_no").rowsBetween(Window.unboundedPreceding, -1)
    return (lined.withColumn("here", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, "run")
            .select("b_key", "b_block", "b_slot", (F.col("start") + F.col("here")).alias("b_start")))


def numbered(docs: DataFrame, id_col: str, source_col: str,
             bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(_doc, _key, _rank): rows as structs, source key, and place 0.. within the source.

    The order is that of the id's MD5, so it is well mixed and stays the same however the rows are
    dealt out. Rows are numbered within (source, hash range); the ranges' counts give the offsets, so
    a source of any size is spread over as many tasks as it needs.
    """
    buckets = max(1, -(-docs.count() // bucket_rows))
    text_id = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    digest = F.md5(text_id)
    # 32 bits of the digest cut into `buckets` equal ranges
    bucket = F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") * buckets, 32)
    keyed = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(id_col).alias("_id"),
                        source_key(F.col(source_col)).alias("_key"),
                        digest.alias("_digest"), bucket.alias("_bucket"))
    sizes = keyed.groupBy("_key", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = (Window.partitionBy("_key").orderBy("_bucket")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_key", "_bucket", F.coalesce(
        F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_key", "_bucket").orderBy("_digest", "_id"))
    return (keyed.withColumn("_place", place - 1).join(starts, ["_key", "_bucket"])
            .withColumn("_rank", F.col("_start") + F.col("_place"))
            .select("_doc", "_key", "_rank"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS,
                cycle: int = CYCLE) -> DataFrame:
    """`docs` with `mix_block`, `mix_slot` and `mix_position`, the row's place 0.. in the mix.

    `weights` (source, weight) are whole numbers; by default `root_weights` makes them, over `cycle` slots,
    or over `SOURCE_SLOTS` slots per source where there are more sources than slots. Up to the slot
    at which the first source runs out, each source is within one block of its share after every slot;
    later, slots of finished sources stay empty. No row is dropped or repeated: a source missing from
    `weights` or with no positive weight is an error. A null source is a source of its own. Rows that
    share an id follow each other. Of clashing columns in `docs` the old ones are replaced. An empty
    table gives no rows.
    """
    docs = docs.drop("mix_block", "mix_slot", "mix_position")
    counts = docs.groupBy(source_key(F.col(source_col)).alias("key")).agg(
        F.count(F.lit(1)).alias("rows"))
    counts = stage(counts, "mix-counts")
    sources = counts.count()
    if weights is None:
        shares = root_weights(counts, cycle if sources <= cycle else SOURCE_SLOTS * sources)
    else:
        wanted = weights.select(source_key(F.col("source")).alias("_k"),
                                F.col("weight").cast("bigint").alias("_w"))
        missing = F.raise_error(F.concat(F.lit("no weight for source "), F.col("key")))
        shares = counts.join(wanted, F.col("key") == F.col("_k"), "left").select(
            "key", "rows", F.when(F.col("_w") > 0, F.col("_w")).otherwise(
                missing.cast("bigint")).alias("weight"))
    if sources > min(cycle, CYCLE):
        placed = stage(block_places(shares, block_rows), "mix-places")
        return numbered(docs, id_col, source_col).withColumn(
            "mix_block", F.expr(f"_rank div {block_rows}")).join(
            placed, (F.col("_key") == F.col("b_key")) & (F.col("mix_block") == F.col("b_block"))).select(
            "_doc.*", "mix_block", F.col("b_slot").alias("mix_slot"),
            (F.col("b_start") + F.expr(f"_rank % {block_rows}")).alias("mix_position"))
    schedule = cycle_schedule(shares).select(
        F.col("key").alias("_s_key"), F.col("share").alias("_s_share"), F.col("nth").alias("_nth"),
        F.col("slot").alias("_slot"), F.col("before").alias("_before"),
        F.col("shares").alias("_shares"), F.col("sizes").alias("_sizes"))
    lengths = shares.select(F.col("key").alias("_w_key"), F.col("weight").alias("_share"))
    blocks = numbered(docs, id_col, source_col).withColumn(
        "mix_block", F.expr(f"_rank div {block_rows}"))
    # both small sides have at most one row per slot of a cycle, which is a parameter
    owned = blocks.join(F.broadcast(lengths), F.col("_key") == F.col("_w_key")).withColumn(
        "_turn", F.expr("mix_block % _share"))
    placed = owned.join(F.broadcast(schedule), (F.col("_key") == F.col("_s_key"))
                        & (F.col("_turn") == F.col("_nth")))
    h = "aggregate(_shares, 0L, (a, x) -> a + x)"
    return placed.withColumn("_round", F.expr("mix_block div _share")).withColumns({
        "mix_slot": F.expr(f"_round * {h} + _slot"),
        "mix_position": F.expr(f"""_rank % {block_rows} + aggregate(
            sequence(0, size(_shares) - 1), 0L, (a, i) -> a + least(
                _sizes[i], {block_rows}L * (_round * _shares[i] + _before[i])))"""),
    }).select("_doc.*", "mix_block", "mix_slot", "mix_position")
