"""Find the rows in which two large tables differ without shuffling either.

Both tables are summed up by ranges of an integer key: rows and an order-free checksum for each range,
combined on the map side. Ranges that agree are left out, those that differ are cut into smaller ones
and summed up again; the filter on them reaches the scan, so that of sorted or clustered files only
those with such keys are read. At the end the few rows of the ranges that still differ meet by key.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 64
#: Ranges of so few key values are compared row by row, and no more ranges than this are cut further.
LEAF, MOST = 1024, 1024


def _row_sum(columns: Sequence[str]) -> list[Column]:
    """Number of rows and an order-free checksum; a hash passes over NULLs, so these are hashed as flags."""
    parts = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*parts).cast("decimal(38,0)")).alias("sum"),
            F.bit_xor(F.xxhash64(F.lit("again"), *parts)).alias("mix")]


def _unlike(left: DataFrame, right: DataFrame, by: Column, columns: Sequence[str]) -> DataFrame:
    """``by`` of the groups whose sums differ, with the rows on either side."""
    a, b = (df.groupBy(by.alias("g")).agg(*_row_sum(columns)) for df in (left, right))
    a, b = a.select("g", F.struct("n", "sum", "mix").alias("left")), b.select(F.col("g").alias("h"), F.struct("n", "sum", "mix").alias("right"))
    joined = a.join(b, F.col("g").eqNullSafe(F.col("h")), "full_outer")
    return joined.where(~F.col("left").eqNullSafe(F.col("right"))).select(
        F.coalesce("g", "h").alias("g"), F.coalesce("left.n", F.lit(0)).alias("left_rows"), F.coalesce("right.n", F.lit(0)).alias("right_rows"))


def _within(key: str, starts: Sequence[int | None], width: int) -> Column:
    """Whether the key lies in one of the ranges; neighbouring ranges are joined."""
    parts, ordered = [], sorted(s for s in starts if s is not None)
    at = 0
    while at < len(ordered):
        end = at
        while end + 1 < len(ordered) and ordered[end + 1] == ordered[end] + width:
            end += 1
        parts.append((F.col(key) >= ordered[at]) & (F.col(key) < ordered[end] + width))
        at = end + 1
    if None in starts:
        parts.append(F.col(key).isNull())
    return reduce(or_, parts)


def locate_differences(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``key, left_rows, right_rows`` of every key whose rows are not the same on both sides.

    ``columns`` are compared (by default those that both have), rows that are there several times
    included. NULL is a key like any other. Two empty tables differ nowhere.
    """
    compared = list(columns or [c for c in left.columns if c in right.columns])
    ends = left.select(key).union(right.select(key)).agg(F.min(key), F.max(key)).first()
    nothing = _unlike(left.where("false"), right.where("false"), F.col(key), compared).withColumnRenamed("g", key)
    if ends[0] is None:
        low, width, starts = 0, 1, [None]
    else:
        low, width, starts = int(ends[0]), LEAF, [int(ends[0]), None]
        while width <= int(ends[1]) - low:  # one range at first, whose cuts line up down to the last
            width *= FANOUT
    while width > LEAF:
        inside, finer = _within(key, starts, width), width // FANOUT
        place = F.expr(f"CAST({low} + (`{key}` - {low}) div {finer} * {finer} AS BIGINT)")
        # sums of ranges are few: FANOUT for each range that differs, and of these at most MOST are cut
        found = _unlike(left.where(inside), right.where(inside), place, compared).limit(MOST + 1).collect()
        if not found:
            return nothing
        if len(found) > MOST:
            break  # they differ all over: the rows of the ranges so far are compared at once
        starts, width = [r.g for r in found], finer
    inside = _within(key, starts, width)
    return _unlike(left.where(inside), right.where(inside), F.col(key), compared).withColumnRenamed("g", key)
