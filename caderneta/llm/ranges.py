"""Sorted keys dealt to ranges, so that many tasks build one trie over them.

Ranges are cut at bounds drawn from the keys.  A prefix that keys of two ranges share is a
prefix of each bound between them, so a range learns from its two bounds alone which of
its prefixes other ranges may have.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE_KEYS = 20_000
DRAWN = 16  # keys drawn for each range; they decide how even ranges are, nothing else
REACH = 64  # code points of a bound


def draw_bounds(keys: DataFrame, key: str, range_keys: int = RANGE_KEYS) -> list[str]:
    """The bounds, ascending, between ranges of about ``range_keys`` of the keys.

    Their number grows with the table: 64 characters at most for each 20,000 keys.
    """
    ranges = keys.count() // range_keys + 1
    if ranges == 1:
        return []
    share = min(1.0, DRAWN / range_keys)
    drawn = keys.filter(F.xxhash64(key) <= F.lit(int(-(2**63) + share * (2**64 - 2**12))))
    cut = drawn.select(F.substring(key, 1, REACH).alias("cut")).collect()
    cuts = sorted(r["cut"] for r in cut)
    return sorted({cuts[len(cuts) * k // ranges] for k in range(1, ranges)}) if cuts else []


def range_of(key: str, bounds: list[str]) -> int:
    """The number of bounds not above ``key``."""
    return bisect_right(bounds, key)


def dealt(rows: DataFrame, bounds: list[str], *order: Column | str) -> DataFrame:
    """Rows of a range together and sorted; a task may get several ranges."""
    return rows.repartition(len(bounds) + 1, "range").sortWithinPartitions("range", *order)


def common(a: str, b: str) -> int:
    """The length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while a[low] == b[low]:
        low += 1
    return low
