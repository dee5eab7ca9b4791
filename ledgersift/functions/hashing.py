"""Repeatable pseudo-random draws from column values.

`rand()` and `DataFrame.sample` depend on how rows fall into partitions. A hash of the row's own
values does not, so a sample stays the same when the cluster, the file layout or a retry changes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hex(parts: list[Column], seed: int | str, n: int) -> Column:
    key = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.substring(F.md5(key), 1, n)


def hash_bits(parts: list[Column], seed: int | str) -> Column:
    """A whole number in [0, 2^48)."""
    return F.conv(_hex(parts, seed, 12), 16, 10).cast("bigint")


def hash_fraction(parts: list[Column], seed: int | str) -> Column:
    """A double in [0, 1)."""
    return F.conv(_hex(parts, seed, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def hash_below(parts: list[Column], seed: int | str, fraction: float) -> Column:
    """`hash_fraction(parts, seed) < fraction`, decided on the hex digits alone."""
    limit = math.ceil(fraction * 2**32)
    if limit >= 2**32:
        return F.lit(True)
    return _hex(parts, seed, 8) < F.lit(f"{max(limit, 0):08x}")
