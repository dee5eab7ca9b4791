"""Counts, descriptive statistics, correlation and frequencies."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.operators.quantiles import approx_median, exact_quantiles
from ledgersift.operators.sizing import rows_from_columns

SUMS_AT_ONCE = 80   # aggregates with more fields than about a hundred are not compiled


def count_rows(df: DataFrame, step: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(step).alias("step"), "n")


def step_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts on both sides of a cleaning step."""
    return count_rows(before, "before").unionByName(count_rows(after, "after"))


def schema_report(df: DataFrame) -> DataFrame:
    """Column name, type and number of non-null values."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return rows_from_columns(counts, df.columns, {
        "type": {f.name: F.lit(f.dataType.simpleString()) for f in df.schema.fields},
        "non_null": {c: F.col(c) for c in df.columns}})


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls in each column."""
    return df.agg(*[
        F.coalesce(F.sum(F.col(c).isNull().cast("bigint")), F.lit(0)).alias(c)
        for c in df.columns])


def describe(df: DataFrame, columns: list[str] | None = None,
             quartiles: bool = False) -> DataFrame:
    """One row per column: n, mean, std, min and max, and the quartiles if asked for.

    Numeric columns fill `min` and `max`; string columns fill `min_text` and `max_text` only.
    """
    columns = columns or df.columns
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    text = [c for c in columns if c not in numeric]
    # least and greatest texts cannot be compiled with the sums, so each kind has its own aggregate
    found = {c: {} for c in columns}
    for group, functions in ((numeric, (("n", F.count), ("mean", F.mean), ("std", F.stddev_samp),
                                        ("min", F.min), ("max", F.max))),
                             (text, (("n", F.count), ("min_text", F.min), ("max_text", F.max)))):
        if group:
            row = df.agg(*[f(c).alias(f"{name}_{i}") for i, c in enumerate(group)
                           for name, f in functions]).first()
            for i, c in enumerate(group):
                found[c] = {name: row[f"{name}_{i}"] for name, _ in functions}
    rows = [(c, found[c]["n"], *[None if found[c].get(p) is None else float(found[c][p])
                                 for p in ("mean", "std", "min", "max")],
             *[None if found[c].get(p) is None else str(found[c][p]) for p in ("min_text", "max_text")])
            for c in columns]
    table = df.sparkSession.createDataFrame(
        rows, "column string, n bigint, mean double, std double, min double, max double, "
              "min_text string, max_text string")
    if not quartiles or not numeric:
        return table
    names = {0.25: "q1", 0.5: "median", 0.75: "q3"}
    quarters = exact_quantiles(df, numeric, list(names))
    wide_q = quarters.groupBy("column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in names.items()])
    return table.join(F.broadcast(wide_q), "column", "left")


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def class_counts(df: DataFrame, by: str = "fraud") -> DataFrame:
    return group_count(df, by)


def group_means(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    return df.groupBy(by).agg(*[F.mean(c).alias(f"mean_{c}") for c in columns])


def moments(df: DataFrame, column: str) -> DataFrame:
    """One row: mean and sample standard deviation."""
    return df.agg(F.mean(column).alias("mean"), F.stddev_samp(column).alias("std"))


def class_stats(df: DataFrame, by: str, columns: list[str], median: str = "exact",
                accuracy: int = 10_000) -> DataFrame:
    """Per class: mean, median and sample standard deviation of each column.

    `median="approx"` is one aggregate. `median="exact"` takes mean and deviation from an aggregate and
    the medians from `exact_quantiles`; there may be any number of classes.
    """
    basic = [f(c).alias(f"{name}_{c}") for c in columns
             for name, f in (("mean", F.mean), ("std", F.stddev_samp))]
    if median == "approx":
        return df.groupBy(by).agg(
            *basic, *[approx_median(c, accuracy).alias(f"median_{c}") for c in columns])
    middle = exact_quantiles(df, columns, [0.5], by).groupBy(F.col(by).alias("_by")).agg(*[
        F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"median_{c}") for c in columns])
    return df.groupBy(by).agg(*basic).join(
        middle, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")


def correlation(df: DataFrame, columns: list[str], invalid: str = "error") -> DataFrame:
    """Pearson matrix as (col_a, col_b, r); r is NaN where a column is constant or has no rows.

    One aggregate finds counts and means, a second the Gram matrix of the centred columns: their sums
    and the sums of their products. A null is an error, or with `invalid="skip"` drops its row, or with
    `invalid="pairwise"` drops the row for the pairs with that column only. Then a column with nulls
    counts as 0 where it is null, and further sums, each over the rows where it is not, give the other
    columns' sums and squares for its pairs. Sums are taken in groups that stay in generated code.
    """
    plain = df.select(*[F.col(c).cast("double").alias(f"x_{i}") for i, c in enumerate(columns)])
    if invalid == "skip":
        plain = plain.dropna()
    places = range(len(columns))
    first = _plain_sums(plain, {
        "n": F.count(F.lit(1)), **{f"n_{i}": F.count(f"x_{i}") for i in places},
        **{f"mean_{i}": F.mean(f"x_{i}") for i in places}})
    short = [i for i in places if first[f"n_{i}"] < first["n"]]
    if short and invalid != "pairwise":
        raise ValueError(f"null values in {[columns[i] for i in short]}")

    # centring by any constant leaves r as it is and keeps the sums small
    def centred(i: int) -> Column:
        x = F.col(f"x_{i}") - F.lit(first[f"mean_{i}"] or 0.0)
        return (F.coalesce(x, F.lit(0.0)) if i in short else x).alias(f"d_{i}")

    present = [F.col(f"x_{i}").isNotNull().cast("double").alias(f"m_{i}") for i in short]
    table = plain.select(*[centred(i) for i in places], *present)
    d, m = {i: F.col(f"d_{i}") for i in places}, {i: F.col(f"m_{i}") for i in short}
    sums = {f"x_{i}": F.sum(d[i]) for i in places}
    sums |= {f"xy_{i}_{j}": F.sum(d[i] * d[j]) for i in places for j in places if i <= j}
    sums |= {f"both_{i}_{j}": F.sum(m[i] * m[j]) for i in short for j in short if i < j}
    for j in short:
        sums |= {f"x_{i}_in_{j}": F.sum(d[i] * m[j]) for i in places if i != j}
        sums |= {f"xx_{i}_in_{j}": F.sum(d[i] * d[i] * m[j]) for i in places if i != j}
    total = _plain_sums(table, sums)

    def r(i: int, j: int) -> float:
        i, j = min(i, j), max(i, j)
        if i in short and j in short and i != j:
            n = total[f"both_{i}_{j}"]
        else:
            n = min(first[f"n_{i}"], first[f"n_{j}"])
        # a column's own zeros add nothing, so only the partner's nulls narrow its sums
        x, xx = (total[f"x_{i}_in_{j}"], total[f"xx_{i}_in_{j}"]) if j in short and i != j else (
            total[f"x_{i}"], total[f"xy_{i}_{i}"])
        y, yy = (total[f"x_{j}_in_{i}"], total[f"xx_{j}_in_{i}"]) if i in short and i != j else (
            total[f"x_{j}"], total[f"xy_{j}_{j}"])
        if not n:
            return math.nan
        scale = math.sqrt(max(0.0, xx - x * x / n)) * math.sqrt(max(0.0, yy - y * y / n))
        if scale == 0:
            return math.nan
        return 1.0 if i == j else (total[f"xy_{i}_{j}"] - x * y / n) / scale

    rows = [(a, b, r(i, j)) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def _plain_sums(df: DataFrame, sums: dict[str, Column], group: int = SUMS_AT_ONCE) -> dict:
    """One row of aggregates by name, null as 0; more than generated code takes run one after another."""
    names, found = list(sums), {}
    for at in range(0, len(names), group):
        part = names[at:at + group]
        found |= df.agg(*[sums[n].alias(n) for n in part]).first().asDict()
    return {n: v or 0.0 for n, v in found.items()}


def describe_categorical(df: DataFrame, column: str) -> DataFrame:
    """Count, number of distinct values, most frequent value and its count (ties: least value)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col(column).cast("string").alias("v")))
    return counts.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct"), top.alias("top_entry"),
    ).select("n", "distinct", F.col("top_entry.v").alias("top"),
             (-F.col("top_entry.minus_n")).alias("freq"))


def fraud_frequency(df: DataFrame, key: str, first: int, last: int) -> DataFrame:
    """Suspicious rows for each whole-number key from `first` to `last`, zero where there are none."""
    counts = df.groupBy(F.col(key).cast("bigint").alias(key)).agg(F.count(F.lit(1)).alias("n"))
    wanted = counts.filter(F.col(key).between(first, last))  # at most last - first + 1 rows
    domain = df.sparkSession.range(first, last + 1).select(F.col("id").alias(key))
    return domain.join(F.broadcast(wanted), key, "left").select(
        F.col(key).cast("int").alias(key), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
