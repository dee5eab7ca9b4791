"""The data behind histograms, density curves, box plots, scatter and pair plots."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.operators.quantiles import exact_quantiles
from ledgersift.operators.sizing import rows_from_columns, small_rows, small_table

# Beyond this many bandwidths exp(-z * z / 2) is zero in double precision, so nothing is left out.
REACH = 39.0
CELL = 0.25          # width of a cell in bandwidths
TERMS = 12           # powers kept per cell
# exp(-z^2/2) |He_k(z)| is at most 1.09 sqrt(k!), so the series misses no more than this of a peak
SERIES_ERROR = sum(1.09 * (CELL / 2) ** k / math.sqrt(math.factorial(k)) for k in range(TERMS, 60))
CLASSES_HELD = 64    # classes whose counters a task of `pair_density` holds before it hands them on


def _hermite(terms: int) -> list[list[int]]:
    """Coefficients of the polynomials He_0, He_1, ... by rising power."""
    found = [[1] + [0] * (terms - 1), [0, 1] + [0] * (terms - 2)]
    for k in range(1, terms - 1):
        found.append([(found[k][j - 1] if j else 0) - k * found[k - 1][j] for j in range(terms)])
    return found


HERMITE = _hermite(TERMS)


def value_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, lo, hi) as a local table, from one aggregate."""
    wide = df.agg(*[
        f(c).cast(t).alias(f"{name}_{i}") for i, c in enumerate(columns)
        for name, f, t in (("n", F.count, "bigint"), ("lo", F.min, "double"),
                           ("hi", F.max, "double"))])
    return small_table(rows_from_columns(wide, columns, {
        p: {c: F.col(f"{p}_{i}") for i, c in enumerate(columns)} for p in ("n", "lo", "hi")}),
        "columns")


def _bin_plan(df: DataFrame, ranges: list, bins: dict[str, int]) -> DataFrame:
    """(column, lo, width, bins); a constant column gets a range of one around its value."""
    plan = []
    for r in ranges:
        lo, hi = (r["lo"] - 0.5, r["hi"] + 0.5) if r["lo"] == r["hi"] else (r["lo"], r["hi"])
        plan.append((r["column"], lo, (hi - lo) / bins[r["column"]], bins[r["column"]]))
    return df.sparkSession.createDataFrame(
        plan, "column string, lo double, width double, bins bigint")


def _bin_index(x: Column, lo: Column, width: Column, bins: Column) -> Column:
    """Equal-width bin, null for null; the last one is closed at its upper end."""
    return F.when(x.isNotNull(), F.least(F.floor((x - lo) / width), bins - 1))


def _binned(df: DataFrame, columns: list[str], plan: DataFrame) -> DataFrame:
    entries = [F.struct(F.lit(r["column"]).alias("column"), _bin_index(
        F.col(r["column"]).cast("double"), F.lit(r["lo"]), F.lit(r["width"]),
        F.lit(r["bins"])).alias("bin")) for r in plan.collect() if r["column"] in columns]
    return (df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter("bin IS NOT NULL")
            .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n")))


def _with_edges(rows: DataFrame) -> DataFrame:
    return rows.select(
        "column", F.col("bin").cast("bigint").alias("bin"),
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def histogram(df: DataFrame, columns: list[str], bins: int = 30) -> DataFrame:
    """(column, bin, bin_low, bin_high, n) with empty bins kept."""
    ranges = [r for r in value_ranges(df, columns).collect() if r["n"]]
    plan = _bin_plan(df, ranges, {c: bins for c in columns})
    counts = _binned(df, columns, plan)  # at most columns x bins rows
    slots = plan.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bins") - 1))
                        .alias("bin"))
    return _with_edges(slots.join(F.broadcast(counts), ["column", "bin"], "left"))


def histogram_auto(df: DataFrame, columns: list[str]) -> DataFrame:
    """Histogram with the number of bins taken from the data; occupied bins only.

    Bin width is the smaller of the Freedman-Diaconis and Sturges widths. Heavy tails can ask for
    far more bins than there are rows, so empty ones are left out.
    """
    ranges = [r for r in value_ranges(df, columns).collect() if r["n"]]
    columns = [r["column"] for r in ranges]
    quarters = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(
        df, columns, [0.25, 0.75]).collect()}
    bins = {}
    for r in ranges:
        span, n = r["hi"] - r["lo"], r["n"]
        iqr = quarters[r["column"], 0.75] - quarters[r["column"], 0.25]
        fd = 2.0 * iqr * n ** (-1.0 / 3.0)
        sturges = span / (math.log2(n) + 1.0)
        width = min(fd, sturges) if fd > 0 else sturges
        bins[r["column"]] = max(1, math.ceil(span / width)) if width > 0 else 1
    plan = _bin_plan(df, ranges, bins)
    return _with_edges(_binned(df, columns, plan).join(F.broadcast(plan), "column"))


def kde(df: DataFrame, columns: list[str], by: str | None = None, grid: int = 200,
        cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density (column, [by], point, x, density), Scott's bandwidth.

    Each column and class has its own bandwidth, even grid and unit area. A fast Gauss transform: every
    value is counted into a cell of a quarter bandwidth, which keeps the first powers of the distance
    from its centre, summed before the shuffle. So a curve is as many rows as there are cells with values,
    whatever the number of rows; each cell then adds its Hermite series to the grid points in reach. The
    series leaves out less than `SERIES_ERROR` of a kernel's peak per value, so a density is within
    `SERIES_ERROR / (bandwidth * sqrt(2 pi))`, besides rounding. Classes are few; their curves' settings go
    to every task. Columns without spread, and those with NaN or infinite values, have no curve.
    """
    curve = _curves(df, columns, by, grid, cut)
    places = {c: i for i, c in enumerate(columns)}
    settings: dict = {}
    for r in curve.collect():
        settings.setdefault(r["_of"], {})[places[r["column"]]] = (r["curve"], r["lo"], r["bw"] * CELL)
    fields = "".join(f", c_{i} bigint, lo_{i} double, w_{i} double" for i in places.values())
    kind = (df.schema[by].dataType if by else T.StringType()).simpleString()
    wide = df.sparkSession.createDataFrame(
        [(cls, *(v for i in places.values() for v in found.get(i, (None, None, None))))
         for cls, found in settings.items()], f"_of {kind}{fields}")
    rows = df.select(_class(by), *[F.col(c).cast("double").alias(f"x_{i}") for c, i in places.items()])
    located = rows.join(F.broadcast(wide), F.col("_class").eqNullSafe(F.col("_of")))
    entries = []
    for i in places.values():
        at = (F.col(f"x_{i}") - F.col(f"lo_{i}")) / F.col(f"w_{i}")
        entries.append(F.struct(F.col(f"c_{i}").alias("curve"), F.floor(at).alias("cell"),
                                ((at - F.floor(at) - 0.5) * CELL).alias("u")))
    values = located.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter(
        "curve IS NOT NULL AND cell IS NOT NULL")
    cells = values.groupBy("curve", "cell").agg(*[
        F.sum(_power("u", k)).alias(f"m_{k}") for k in range(TERMS)])
    spread = _near_points(cells.join(F.broadcast(curve), "curve"), grid)
    z = (F.col("lo") + F.col("point") * F.col("step") - F.col("centre")) / F.col("bw")
    series = F.col(f"h_{TERMS - 1}")
    for j in range(TERMS - 2, -1, -1):
        series = series * F.col("z") + F.col(f"h_{j}")
    sums = spread.withColumn("z", z).groupBy("curve", "point").agg(
        F.sum(F.exp(-0.5 * F.col("z") * F.col("z")) * series).alias("total"))
    slots = curve.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    density = F.greatest(F.coalesce("total", F.lit(0.0)), F.lit(0.0)) / (
        F.col("n_all") * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))
    out = slots.join(F.broadcast(sums), ["curve", "point"], "left")  # at most curves x grid rows
    return out.select(
        "column", *([F.col("_of").alias(by)] if by else []), "point",
        (F.col("lo") + F.col("point") * F.col("step")).alias("x"), density.alias("density"))


def _class(by: str | None) -> Column:
    return (F.col(by) if by else F.lit("all")).alias("_class")


def _power(column: str, k: int) -> Column:
    out = F.lit(1.0)
    for _ in range(k):
        out = out * F.col(column)
    return out


def _curves(df: DataFrame, columns: list[str], by: str | None, grid: int, cut: float) -> DataFrame:
    """(curve, column, _of, n_all, bw, lo, step) as a local table, from one aggregate without exploding."""
    rows = df.select(_class(by), *[F.col(c).cast("double").alias(f"x_{i}") for i, c in enumerate(columns)])
    wide = rows.groupBy("_class").agg(*[
        f(f"x_{i}").alias(f"{name}_{i}") for i in range(len(columns))
        for name, f in (("n", F.count), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])
    stats = [(c, r["_class"], *(r[f"{name}_{i}"] for name in ("n", "std", "min", "max")))
             for r in small_rows(wide, f"classes of {by}") for i, c in enumerate(columns)]
    plan = []
    for c, cls, n, std, low, high in stats:
        if n > 1 and std and math.isfinite(std) and math.isfinite(high):
            bw = std * float(n) ** -0.2
            plan.append((len(plan), c, cls, n, bw, low - cut * bw, (high - low + 2 * cut * bw) / (grid - 1)))
    kind = (df.schema[by].dataType if by else T.StringType()).simpleString()
    return df.sparkSession.createDataFrame(
        plan, f"curve bigint, column string, _of {kind}, n_all bigint, bw double, lo double, step double")


def _near_points(cells: DataFrame, grid: int) -> DataFrame:
    """Each cell at each grid point in reach, with its series as a polynomial `h_0..` in z."""
    # sum of He_k(z) m_k / k! over k, gathered by powers of z
    gathered = []
    for j in range(TERMS):
        parts = [F.col(f"m_{k}") * (HERMITE[k][j] / math.factorial(k))
                 for k in range(TERMS) if HERMITE[k][j]]
        gathered.append(sum(parts[1:], parts[0]).alias(f"h_{j}"))
    centre = F.col("lo") + (F.col("cell") + 0.5) * CELL * F.col("bw")
    found = cells.select("curve", "lo", "step", "bw", centre.alias("centre"), *gathered)
    reach = (REACH + CELL) * F.col("bw")
    first = F.greatest(F.ceil((F.col("centre") - reach - F.col("lo")) / F.col("step")), F.lit(0))
    last = F.least(F.floor((F.col("centre") + reach - F.col("lo")) / F.col("step")), F.lit(grid - 1))
    return found.filter(first <= last).select(
        "*", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("point"))


def boxplot_stats(df: DataFrame, columns: list[str], whisker: float = 1.5) -> DataFrame:
    """Per column: quartiles, whisker ends, and the number of rows beyond the whiskers."""
    names = {0.25: "q1", 0.5: "median", 0.75: "q3"}
    quarters = small_rows(exact_quantiles(df, columns, list(names)), "columns")
    q = {(r["column"], names[r["prob"]]): r["value"] for r in quarters}
    found = [c for c in columns if q.get((c, "q1")) is not None]
    aggregates = []
    for i, c in enumerate(found):
        reach = whisker * (q[c, "q3"] - q[c, "q1"])
        x = F.col(c).cast("double")
        low, high = F.lit(q[c, "q1"] - reach), F.lit(q[c, "q3"] + reach)
        aggregates += [
            F.count(x).alias(f"n_{i}"),
            F.least(F.min(F.when(x >= low, x)), F.lit(q[c, "q1"])).alias(f"whisker_low_{i}"),
            F.greatest(F.max(F.when(x <= high, x)), F.lit(q[c, "q3"])).alias(f"whisker_high_{i}"),
            F.coalesce(F.sum(((x < low) | (x > high)).cast("bigint")), F.lit(0))
            .alias(f"outliers_{i}")]
    parts = {p: {c: F.col(f"{p}_{i}") for i, c in enumerate(found)}
             for p in ("n", "whisker_low", "whisker_high", "outliers")}
    for name in names.values():
        parts[name] = {c: F.lit(q[c, name]) for c in found}
    return rows_from_columns(df.agg(*aggregates), found, parts)


def scatter_pairs(df: DataFrame, xs: list[str], ys: list[str], by: str) -> DataFrame:
    """(x_name, y_name, x, y, by): every row once per pair of columns."""
    entries = [F.struct(F.lit(a).alias("x_name"), F.lit(b).alias("y_name"),
                        F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
               for a in xs for b in ys]
    return df.select(by, F.explode(F.array(*entries)).alias("e")).select("e.*", by)


def pair_density(df: DataFrame, columns: list[str], by: str, bins: int = 30) -> DataFrame:
    """2-D bin counts per class for every pair of columns (and each column with itself).

    A pair plot of a large table is its density; counting in bins keeps every row in the result. Each task
    keeps one array of counters per class and pair and hands on those above zero, so a row is read once
    and not repeated per pair, and the shuffle carries at most pairs x bins^2 x classes rows per task.
    """
    ranges = {r["column"]: r for r in value_ranges(df, columns).collect() if r["n"]}
    found = [c for c in columns if c in ranges]
    plan = {r["column"]: r for r in
            _bin_plan(df, list(ranges.values()), {c: bins for c in found}).collect()}
    located = df.select(F.col(by).alias("by"), *[F.coalesce(_bin_index(
        F.col(c).cast("double"), F.lit(plan[c]["lo"]), F.lit(plan[c]["width"]), F.lit(bins)).cast("int"),
        F.lit(-1)).alias(f"b_{i}") for i, c in enumerate(found)])
    kind = df.schema[by].dataType.simpleString()
    pairs = list(combinations_with_replacement(range(len(found)), 2))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def rows(type_: pa.DataType):
            for cls, counters in held.items():
                pair, cell = np.nonzero(counters)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cls] * len(pair), type_), pa.array(pair, pa.int32()),
                     pa.array(cell, pa.int32()), pa.array(counters[pair, cell])], ["by", "pair", "cell", "n"])

        for batch in batches:
            type_ = batch.schema.field(0).type
            codes = batch.column(0).dictionary_encode("encode")
            at = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]).astype(np.int64)
            number = codes.indices.to_numpy(zero_copy_only=False)
            for k, cls in enumerate(codes.dictionary.to_pylist()):
                mine = at[:, number == k]
                counters = held.setdefault(cls, np.zeros((len(pairs), bins * bins), dtype=np.int64))
                for p, (i, j) in enumerate(pairs):
                    both = (mine[i] >= 0) & (mine[j] >= 0)
                    counters[p] += np.bincount(mine[i][both] * bins + mine[j][both], minlength=bins * bins)
            if len(held) > CLASSES_HELD:
                yield from rows(type_)
                held.clear()
        if held:
            yield from rows(type_)

    names = df.sparkSession.createDataFrame(
        [(p, found[i], found[j]) for p, (i, j) in enumerate(pairs)], "pair int, x_name string, y_name string")
    counts = located.mapInArrow(count, f"by {kind}, pair int, cell int, n bigint").groupBy(
        "by", "pair", "cell").agg(F.sum("n").alias("n"))
    return counts.join(F.broadcast(names), "pair").select(
        "x_name", "y_name", F.floor(F.col("cell") / bins).cast("int").alias("bin_x"),
        (F.col("cell") % bins).alias("bin_y"), F.col("by").alias(by), "n")
