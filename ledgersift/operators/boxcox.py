"""Box-Cox: the profile likelihood of lambda and its maximum, for several columns at once.

Three scans at any size of the table. The first takes count, range and mean logarithm of each column. The
second counts w = ln y - mean(ln y) into cells and keeps sums of powers of the distance from each cell's
centre, from which the likelihood at any lambda follows as a series; the search reads only these. The
third takes exact sums at three lambdas around the top, whose parabola gives the answer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersift.operators.sizing import small_rows

FIRST_POINTS = 17   # from -2 to 2
NEXT_POINTS = 5
ROUNDS = 7
WIDEST = 1000.0
CELL = 1.0 / 32     # width of a cell of ln y
TERMS = 12          # powers kept per cell
SERIES_UP_TO = 12.0  # larger lambdas are evaluated on the rows: there the series would lose digits
LAST_STEP = 1e-3    # distance of the three lambdas of the last scan
MAX_CELLS = 50_000  # more than the logarithms of all doubles fill


class BoxCoxError(ValueError):
    """The transform is not defined for a column."""


def _require_spread(column: str, stats: dict) -> None:
    if stats["n"] < 2:
        raise BoxCoxError(f"{column}: too few values")
    if not stats["lo"] > 0:
        raise BoxCoxError(f"{column}: values + 1 must be positive")
    if stats["lo"] == stats["hi"]:
        raise BoxCoxError(f"{column}: all values are equal, no lambda exists")


class _Likelihood:
    """Likelihoods of y = x + 1, from the rows (`exact`) or from the summary (`near`).

    With w = ln y - mean(ln y), the transformed values divided by the geometric mean's power are
    t = (e^(lambda w) - 1) / lambda, so the sums stay near one for any scale of the data.
    """

    def __init__(self, df: DataFrame, columns: list[str]):
        self.columns = columns
        self.rows = df.select(*[F.col(c).cast("double").alias(f"x_{i}") for i, c in enumerate(columns)])
        log = [F.ln(F.col(f"x_{i}") + 1.0) for i in range(len(columns))]
        found = self.rows.agg(*[f.alias(f"{name}_{i}") for i in range(len(columns)) for name, f in (
            ("n", F.count(f"x_{i}")), ("lo", F.min(f"x_{i}") + 1.0), ("hi", F.max(f"x_{i}") + 1.0),
            ("mean_log", F.mean(log[i])))]).first()
        self.stats = {c: {name: found[f"{name}_{i}"] for name in ("n", "lo", "hi", "mean_log")}
                      for i, c in enumerate(columns)}
        for c in columns:
            _require_spread(c, self.stats[c])
        self.summary: dict[str, tuple[np.ndarray, np.ndarray]] | None = None

    def _w(self, column: str) -> Column:
        return F.ln(F.col(f"x_{self.columns.index(column)}") + 1.0) - F.lit(self.stats[column]["mean_log"])

    def _value(self, column: str, s1: float | None, s2: float | None) -> float:
        s = self.stats[column]
        if s1 is None or s2 is None:
            return -math.inf
        var = s2 / s["n"] - (s1 / s["n"]) ** 2
        return (-s["n"] * s["mean_log"] - s["n"] / 2 * math.log(var)
                if 0 < var < math.inf else -math.inf)

    def exact(self, grid: dict[str, Sequence[float]]) -> dict[str, list[float]]:
        """One aggregate over the rows, two sums per column and lambda."""
        sums = []
        for c, lams in grid.items():
            w = self._w(c)
            for k, lam in enumerate(lams):
                t = w if lam == 0 else F.expm1(F.lit(float(lam)) * w) / F.lit(float(lam))
                i = self.columns.index(c)
                sums += [F.sum(t).alias(f"s1_{i}_{k}"), F.sum(t * t).alias(f"s2_{i}_{k}")]
        total = self.rows.agg(*sums).first()
        return {c: [self._value(c, total[f"s1_{self.columns.index(c)}_{k}"],
                                total[f"s2_{self.columns.index(c)}_{k}"]) for k in range(len(lams))]
                for c, lams in grid.items()}

    def _summarise(self) -> None:
        entries = []
        for i, c in enumerate(self.columns):
            at = self._w(c) / F.lit(CELL)
            entries.append(F.struct(F.lit(i).alias("i"), F.floor(at).alias("cell"),
                                    ((at - F.floor(at) - 0.5) * F.lit(CELL)).alias("v")))
        values = self.rows.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter(
            "cell IS NOT NULL")
        powers, power = [], F.lit(1.0)
        for k in range(TERMS):
            powers.append(F.sum(power).alias(f"m_{k}"))
            power = power * F.col("v")
        rows = small_rows(values.groupBy("i", "cell").agg(*powers), "cells of logarithms",
                          MAX_CELLS * len(self.columns))
        self.summary = {}
        for i, c in enumerate(self.columns):
            mine = sorted((r for r in rows if r["i"] == i), key=lambda r: r["cell"])
            self.summary[c] = (np.array([(r["cell"] + 0.5) * CELL for r in mine]),
                               np.array([[r[f"m_{k}"] for k in range(TERMS)] for r in mine]))

    def _series(self, column: str, lam: float) -> float:
        """Sums of t and t^2 by their series around the centres of the cells."""
        centre, moments = self.summary[column]
        with np.errstate(over="ignore", invalid="ignore"):
            terms = [centre if lam == 0 else np.expm1(lam * centre) / lam]
            terms += [lam ** (k - 1) * np.exp(lam * centre) / math.factorial(k) for k in range(1, TERMS)]
            squares = [sum(terms[i] * terms[k - i] for i in range(k + 1)) for k in range(TERMS)]
            s1 = sum(float(t @ moments[:, k]) for k, t in enumerate(terms))
            s2 = sum(float(t @ moments[:, k]) for k, t in enumerate(squares))
        return self._value(column, s1, s2)

    def near(self, grid: dict[str, Sequence[float]]) -> dict[str, list[float]]:
        """From the summary where the series holds, else from the rows."""
        if self.summary is None:
            self._summarise()
        wide = {c: lams for c, lams in grid.items() if max(map(abs, lams)) > SERIES_UP_TO}
        found = self.exact(wide) if wide else {}
        return {c: found[c] if c in found else [self._series(c, lam) for lam in lams]
                for c, lams in grid.items()}


def _even(centre: float, half: float, n: int) -> list[float]:
    points = [centre + half * (2 * i / (n - 1) - 1) for i in range(n)]
    return [0.0 if abs(p) < 1e-12 else p for p in points]


def _top(lams: Sequence[float], llf: Sequence[float], i: int) -> float:
    """The top of the parabola through point i and its neighbours, at most a step away."""
    step = lams[1] - lams[0]
    bend = llf[i - 1] - 2 * llf[i] + llf[i + 1]
    if not (bend < 0 and math.isfinite(bend)):
        return lams[i]
    return lams[i] + max(-step, min(step, (llf[i - 1] - llf[i + 1]) / (2 * bend) * step))


def boxcox_profile(df: DataFrame, columns: list[str], lambdas: Sequence[float]) -> DataFrame:
    """(column, lambda, llf): the log-likelihood at each given lambda, exact, in two scans."""
    found = _Likelihood(df, columns).exact({c: list(lambdas) for c in columns})
    rows = [(c, float(lam), v) for c in columns for lam, v in zip(lambdas, found[c])]
    return df.sparkSession.createDataFrame(rows, "column string, lambda double, llf double")


def boxcox_lambdas(df: DataFrame, columns: list[str], rounds: int = ROUNDS) -> dict[str, float]:
    """The most likely lambda of each column.

    A grid on [-2, 2] is followed by finer ones around the top of the parabola through its best three
    points, all columns together. A best point at an end moves and widens the grid. The last three
    points, `LAST_STEP` apart, are evaluated on the rows.
    """
    likelihood = _Likelihood(df, columns)
    best = _search(likelihood, columns, rounds)
    left = list(columns)
    while left:
        grid = {c: [best[c] - LAST_STEP, best[c], best[c] + LAST_STEP] for c in left}
        found = likelihood.exact(grid)
        left = []
        for c, lams in grid.items():
            i = max(range(3), key=lambda k: (found[c][k], k == 1))
            best[c] = lams[i] if i != 1 else _top(lams, found[c], 1)
            if i != 1 and abs(best[c]) <= WIDEST:
                left.append(c)      # the summary was off by more than a step: look further
    return best


def _search(likelihood: _Likelihood, columns: list[str], rounds: int) -> dict[str, float]:
    grid = {c: _even(0.0, 2.0, FIRST_POINTS) for c in columns}
    left = {c: rounds for c in columns}
    best: dict[str, float] = {}
    while grid:
        found = likelihood.near(grid)
        following = {}
        for c, lams in grid.items():
            llf = found[c]
            i = max(range(len(lams)), key=lambda k: llf[k])
            step = lams[1] - lams[0]
            at_end = i in (0, len(lams) - 1)
            if at_end and c not in best:
                if abs(lams[i]) > WIDEST:
                    raise BoxCoxError(f"{c}: the likelihood has no maximum within +-{WIDEST}")
                following[c] = _even(lams[i], lams[-1] - lams[0], len(lams))
                left[c] += 1
                continue
            best[c] = lams[i] if at_end else _top(lams, llf, i)
            left[c] -= 1
            if left[c] > 0 and step > LAST_STEP:
                following[c] = _even(best[c], step if at_end else step / 4, NEXT_POINTS)
        grid = following
    return best


def boxcox_fit(df: DataFrame, columns: list[str], rounds: int = ROUNDS) -> DataFrame:
    """(column, lambda) as a table."""
    best = boxcox_lambdas(df, columns, rounds)
    return df.sparkSession.createDataFrame(
        [(c, best[c]) for c in columns], "column string, lambda double")
