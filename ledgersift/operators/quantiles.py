"""Exact and approximate quantiles.

Exact quantiles take two scans whatever the size of the table. The first makes a sketch of each group
and column, which proposes a narrow bracket around each wanted rank. The second is one aggregate over
whole rows: it counts the values below each bracket, and its key holds a column's value only where that
lies in a bracket, so all other rows of a group fall together before the shuffle. What it leaves is
stored and tells for certain which values stand at the wanted ranks; should a bracket have missed its
rank, it is widened and the second scan repeated. Sketches only choose where to look, so the answer is
exact.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.operators.stored import stored

SKETCH_K = 4096      # sketch size; a rank is then known to about 0.1 % of the rows
MARGIN = 0.002       # half a bracket's width as a share of the group's rows
SKETCH_SLICES = 64   # sketches are merged in two steps, so no task merges one per input split
STEPS = 500          # quantiles read from a sketch, evenly spaced; brackets begin and end at these
BUCKETS = 1024       # even parts of a bracket whose values are ordered one by one


def approx_median(col: str | Column, accuracy: int = 10_000) -> Column:
    """A value of the column near the middle rank (never an average of two)."""
    return F.percentile_approx(col, 0.5, accuracy)


def exact_median(col: str | Column) -> Column:
    """The exact median as an aggregate, for groups that fit in a task."""
    return F.median(col)


def exact_quantiles(df: DataFrame, columns: list[str], probs: Sequence[float],
                    by: str | None = None, sketch_k: int = SKETCH_K,
                    margin: float = MARGIN) -> DataFrame:
    """([by], column, prob, value) with linear interpolation between neighbouring ranks.

    Nulls are left out; a group without other values has a null value. NaN ranks above all numbers. There
    may be any number of groups.
    """
    rows = df.select((F.col(by) if by else F.lit(0)).alias("_group"),
                     *[F.col(c).cast("double").alias(f"x_{i}") for i, c in enumerate(columns)])
    spots = [(i, k, float(p)) for i in range(len(columns)) for k, p in enumerate(probs)]
    ladders = stored(_ladders(rows, len(columns), sketch_k), "quantile-ladders")
    while True:
        brackets = stored(_brackets(ladders, columns, probs, margin), "quantile-brackets")
        cells = stored(_cells(rows, brackets, spots, by is not None), "quantile-cells")
        found = stored(_values_at(cells, brackets, columns, probs), "quantiles")
        missed = (F.col("rows") > F.col("low")) & F.col("v_low").isNull() | (
            F.col("rows") > F.col("high")) & F.col("v_high").isNull()
        if margin > 1 or found.filter(missed).isEmpty():
            break
        margin *= 8
    nan = F.lit(float("nan"))
    low = F.when(F.col("low") >= F.col("rows"), nan).otherwise(F.col("v_low"))
    high = F.when(F.col("high") >= F.col("rows"), nan).otherwise(F.col("v_high"))
    value = F.when(F.col("share") == 0, low).otherwise(
        low * (1 - F.col("share")) + high * F.col("share"))
    return found.select(
        *([F.col("_g").alias(by)] if by else []), F.col("_c").alias("column"), "prob",
        F.when(F.col("all_rows") > 0, value).alias("value"))


def _ladders(rows: DataFrame, columns: int, k: int) -> DataFrame:
    """(_group, and per column all_i, n_i, min_i, max_i, ladder_i): the first scan, one row per group.

    A ladder holds `STEPS` + 1 even quantiles of the sketch; groups too small to need one have none. `n_i`,
    the range and the sketch leave NaN out, `all_i` does not.
    """
    first, merged, kept = [], [], []
    at = F.lit(np.arange(STEPS + 1) / STEPS)
    for i in range(columns):
        number = f"if(isnan(x_{i}), null, x_{i})"
        first += [f"count(x_{i}) AS all_{i}", f"count({number}) AS n_{i}", f"min({number}) AS min_{i}",
                  f"max({number}) AS max_{i}", f"kll_sketch_agg_double({number}, {k}) AS s_{i}"]
        merged += [f"sum(all_{i}) AS all_{i}", f"sum(n_{i}) AS n_{i}", f"min(min_{i}) AS min_{i}",
                   f"max(max_{i}) AS max_{i}", f"kll_merge_agg_double(s_{i}, {k}) AS s_{i}"]
        kept += [f"all_{i}", f"n_{i}", f"min_{i}", f"max_{i}",
                 F.when(F.col(f"n_{i}") >= STEPS, F.kll_sketch_get_quantile_double(f"s_{i}", at))
                 .alias(f"ladder_{i}")]
    slices = F.expr(f"pmod(spark_partition_id(), {SKETCH_SLICES}) AS _slice")
    return (rows.groupBy("_group", slices).agg(*map(F.expr, first))
            .groupBy("_group").agg(*map(F.expr, merged)).select("_group", *kept))


def _low_rank(count: str, p: str) -> str:
    """The lower of the two ranks that a quantile lies between."""
    return f"cast(floor(greatest({p} * ({count} - 1), 0D)) AS bigint)"


def _brackets(ladders: DataFrame, columns: list[str], probs: Sequence[float], margin: float) -> DataFrame:
    """(_group, and per column all_i, n_i, ends_i): `ends_i` has (lo, hi) per quantile, both within.

    A bracket reaches `margin` beyond the ranks it is for, and over the whole group where that would be
    less than two rows. NaN ranks above all numbers, so the ranks of numbers are those of all values.
    """
    wanted = ", ".join(f"{float(p)!r}D" for p in probs)
    kept = ["_group"]
    for i in range(len(columns)):
        low, n = _low_rank(f"all_{i}", "p"), f"nullif(cast(n_{i} AS double), 0D)"
        ladder = f"if({n} * {margin!r}D >= 2, ladder_{i}, null)"
        first = f"cast(floor(({low} / {n} - {margin!r}D) * {STEPS}) AS int)"
        last = f"cast(ceil((({low} + 2) / {n} + {margin!r}D) * {STEPS}) AS int)"
        kept += [f"all_{i}", f"n_{i}", f"""transform(array({wanted}), p -> struct(
            if({ladder} IS NULL OR {first} <= 0, min_{i}, get({ladder}, least({first}, {STEPS}))) AS lo,
            if({ladder} IS NULL OR {last} >= {STEPS}, max_{i}, get({ladder}, {last})) AS hi)) AS ends_{i}"""]
    return ladders.selectExpr(*kept)


def _cells(rows: DataFrame, brackets: DataFrame, spots: list, grouped: bool) -> DataFrame:
    """(_group, v_i, n, below_i_k, at_i_k): the second scan.

    `v_i` is the value of column i where one of its brackets holds it, else null; a bracket of a single
    value needs no cells, only the number of rows `at` it.
    """
    names = [f"{end}_{i}_{k}" for i, k, _ in spots for end in ("lo", "hi")]
    plain = brackets.selectExpr("_group AS _g", *[
        f"ends_{i}[{k}].{end} AS {end}_{i}_{k}" for i, k, _ in spots for end in ("lo", "hi")])
    if grouped:
        located = rows.join(plain, F.col("_group").eqNullSafe(F.col("_g")))
        ends = {n: n for n in names}
    else:
        row = plain.first()
        located = rows
        ends = {n: "double(null)" if row is None or row[n] is None else f"double('{row[n]!r}')" for n in names}
    inside, sums = {}, ["count(1) AS n"]
    for i, k, _ in spots:
        lo, hi = ends[f"lo_{i}_{k}"], ends[f"hi_{i}_{k}"]
        inside.setdefault(i, []).append(f"({lo} < {hi} AND x_{i} >= {lo} AND x_{i} <= {hi})")
        sums += [f"count(if(x_{i} < {lo}, 1, null)) AS below_{i}_{k}",
                 f"count(if({lo} = {hi} AND x_{i} = {lo}, 1, null)) AS at_{i}_{k}"]
    keys = [f"if({' OR '.join(tests)}, x_{i}, null) AS v_{i}" for i, tests in inside.items()]
    return located.groupBy("_group", *map(F.expr, keys)).agg(*map(F.expr, sums))


def _values_at(cells: DataFrame, brackets: DataFrame, columns: list[str], probs: Sequence[float]) -> DataFrame:
    """(_g, _c, prob, all_rows, rows, low, high, share, v_low, v_high): null where a bracket missed."""
    ks = range(len(probs))
    places = range(len(columns))
    sums = cells.groupBy(F.col("_group").alias("s_group")).agg(*[
        F.expr(f"sum({name}_{i}_{k}) AS {name}_{i}_{k}") for i in places for k in ks for name in ("below", "at")])

    def counts(name: str, i: int) -> str:
        return "array(" + ", ".join(f"{name}_{i}_{k}" for k in ks) + f") AS {name}"

    entries = ", ".join(
        f"struct({i} AS i, all_{i} AS all_rows, n_{i} AS rows, ends_{i} AS ends, {counts('below', i)}, "
        f"{counts('at', i)})" for i in places)
    by_column = brackets.join(sums, F.col("_group").eqNullSafe(F.col("s_group"))).selectExpr(
        "_group AS _g", f"inline(array({entries}))")
    wanted = ", ".join(f"{float(p)!r}D" for p in probs)
    spots = by_column.selectExpr("*", "posexplode(ends) AS (k, end)").selectExpr(
        "_g", "i", "k", "all_rows", "rows", f"array({wanted})[k] AS prob", "end.lo AS lo", "end.hi AS hi",
        "below[k] AS below", "at[k] AS at").withColumn("low", F.expr(_low_rank("all_rows", "prob")))
    ranks = stored(spots.selectExpr(
        "*", "least(low + 1, greatest(all_rows - 1, 0L)) AS high",
        "greatest(prob * (all_rows - 1), 0D) - low AS share"), "quantile-ranks")
    held = cells.selectExpr(
        "_group AS h_group", "n", "inline(array(" + ", ".join(
            f"struct({i} AS h_i, v_{i} AS x)" for i in places) + "))").filter("x IS NOT NULL").groupBy(
        "h_group", "h_i", "x").agg(F.sum("n").alias("n"))
    wanted = ranks.filter("lo < hi").select("_g", "i", "k", "low", "high", "lo", "hi", "below")
    # each value in the even part of its bracket (0 where an end is infinite); then only the parts with a
    # wanted rank are put in order
    part = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BUCKETS)
    parted = held.join(
        wanted, F.col("h_group").eqNullSafe(F.col("_g")) & (F.col("h_i") == F.col("i"))
        & (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))).select(
        "_g", "i", "k", "low", "high", "below", "x", "n", part.alias("part"))
    spot = ["_g", "i", "k"]
    order = Window.partitionBy(*spot).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parted.groupBy(*spot, "part").agg(
        F.sum("n").alias("p_rows"), F.first("low").alias("p_low"), F.first("high").alias("p_high"),
        F.first("below").alias("p_below")).withColumn(
        "p_start", F.col("p_below") + F.coalesce(F.sum("p_rows").over(order), F.lit(0)))

    def holds(rank: str) -> Column:
        return (F.col("p_start") <= F.col(rank)) & (F.col(rank) < F.col("p_start") + F.col("p_rows"))

    chosen = parts.filter(holds("p_low") | holds("p_high")).select(
        *[F.col(c).alias(f"p_{c}") for c in (*spot, "part")], "p_start")
    running = (Window.partitionBy(*spot, "part").orderBy("x")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ordered = parted.join(
        chosen, F.col("_g").eqNullSafe(F.col("p__g")) & (F.col("i") == F.col("p_i"))
        & (F.col("k") == F.col("p_k")) & (F.col("part") == F.col("p_part"))).withColumn(
        "upto", F.col("p_start") + F.sum("n").over(running))

    def at(rank: str) -> Column:
        before = F.col("upto") - F.col("n")
        return F.max(F.when((before <= F.col(rank)) & (F.col(rank) < F.col("upto")), F.col("x")))

    found = ordered.groupBy(*[F.col(c).alias(f"f_{c}") for c in spot]).agg(
        at("low").alias("f_low"), at("high").alias("f_high"))
    match = (F.col("_g").eqNullSafe(F.col("f__g")) & (F.col("i") == F.col("f_i"))
             & (F.col("k") == F.col("f_k")))

    def alone(rank: str) -> Column:
        """The value of a bracket that is a single value, if it stands at the rank."""
        return F.when((F.col("lo") == F.col("hi")) & (F.col("below") <= F.col(rank))
                      & (F.col(rank) < F.col("below") + F.col("at")), F.col("lo"))

    names = F.array(*[F.lit(c) for c in columns])
    return ranks.join(found, match, "left").select(
        "_g", F.get(names, F.col("i")).alias("_c"), "prob", "all_rows", "rows", "low", "high", "share",
        F.coalesce("f_low", alone("low")).alias("v_low"), F.coalesce("f_high", alone("high")).alias("v_high"))
