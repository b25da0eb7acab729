"""Row numbers that scale past one task.

A window without partition columns, or with one huge partition, sorts all its rows in a
single task. Here such rows are range-partitioned on their sort columns instead: each slice is
sorted by its own task, and adding up the sizes of the slices before it turns a row's position
in its slice into its position overall.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage, task_slots

# monotonically_increasing_id keeps the partition number above bit 33, the row number below it.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def _as_column(item: Column | str) -> Column:
    return F.col(item) if isinstance(item, str) else item


def _place(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Range-partition and sort once, stage, and add ``_slice`` and ``_placed``.

    ``_placed`` grows with the order; staging makes counts and positions see one layout.
    """
    slices = task_slots(df.sparkSession)
    placed = stage(
        df.repartitionByRange(slices, *map(_as_column, order))
        .sortWithinPartitions(*map(_as_column, order))
        .withColumn("_placed", F.monotonically_increasing_id()), "positions")
    return placed.withColumn("_slice", F.shiftright("_placed", _ROW_BITS))


def _with_overall(placed: DataFrame, name: str) -> DataFrame:
    """Position in the slice plus the sizes of the slices before it, counted from 1."""
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    # One row per slice: this window and the broadcast are bounded by the slice count.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_placed").bitwiseAND(F.lit(_ROW_MASK)) + 1
    return placed.join(F.broadcast(offsets), "_slice").withColumn(name, position).drop("_before")


def with_position(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Number all rows from 1 by ``order``, with one range shuffle and no single task.

    Put a unique column last in ``order``: it makes the numbers repeatable and lets rows that
    tie on the other columns spread over several slices.
    """
    return _with_overall(_place(df, order), name).drop("_slice", "_placed")


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """``row_number()`` over the whole table."""
    return with_position(df, order, name)


def _by_group(df: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows placed by group and order: a group's rows lie next to each other, over as many slices as
    they need, and only a slice's first group can have begun in an earlier slice."""
    return _place(df, [*by, *order]).withColumn("_key", F.struct(*by))


def group_rank(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """``row_number()`` per group, with no more of a group in one task than a slice holds.

    Rows are numbered per slice and group; a slice's first group goes on counting from the slices
    before. What is carried over is one row per slice.
    """
    placed = _by_group(df, by, order)
    counts = placed.groupBy("_slice", "_key").agg(F.count(F.lit(1)).alias("_size"))
    first = placed.groupBy("_slice").agg(F.min_by("_key", "_placed").alias("_key"))
    ends = placed.groupBy("_slice").agg(F.max_by("_key", "_placed").alias("_key"))
    # only a slice's last group can go on in later slices
    tails = ends.join(counts, ["_slice", "_key"]).select("_slice", "_key", "_size")
    both = (first.select("_slice", "_key", F.lit(0).alias("_end"), F.lit(0).cast("bigint").alias("_size"))
            .union(tails.select("_slice", "_key", F.lit(1), "_size")))
    ordered = Window.partitionBy("_key").orderBy("_slice", "_end").rowsBetween(Window.unboundedPreceding, -1)
    carried = (both.withColumn("_carried", F.coalesce(F.sum("_size").over(ordered), F.lit(0)))
               .where("_end = 0 AND _carried > 0").select("_slice", F.col("_key").alias("_first_key"), "_carried"))
    here = F.row_number().over(Window.partitionBy("_slice", "_key").orderBy("_placed"))
    rows = placed.withColumn("_here", here).join(F.broadcast(carried), "_slice", "left")
    more = F.when(F.col("_key") == F.col("_first_key"), F.col("_carried")).otherwise(0)
    return (rows.withColumn(name, (F.col("_here") + F.coalesce(more, F.lit(0))).cast("bigint"))
            .drop("_slice", "_placed", "_key", "_here", "_first_key", "_carried"))


def overall_and_group_rank(df: DataFrame, order: Sequence[Column | str], overall: str,
                           by: Sequence[str], within: str) -> DataFrame:
    """Both row numbers by one order, from one range shuffle and one hash shuffle.

    The slices already hold the rows in order, so a row's number in its group is its number
    among the group's rows of its slice plus the group's rows in earlier slices. No task gets
    more of a group than one slice holds. Groups are compared as structs, in which NULL equals
    NULL, so that the join needs no shuffle besides the window's.
    """
    placed = _place(df, order).withColumn("_key", F.struct(*by))
    counts = placed.groupBy("_slice", "_key").agg(F.count(F.lit(1)).alias("_size"))
    # Per group at most one row per slice.
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("_slice", "_key", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_earlier"))
    here = Window.partitionBy("_slice", "_key").orderBy("_placed")
    rows = _with_overall(placed, overall).withColumn("_here", F.row_number().over(here))
    joined = rows.join(earlier, ["_slice", "_key"])
    return joined.withColumn(within, F.col("_earlier") + F.col("_here")).drop(
        "_slice", "_placed", "_key", "_here", "_earlier")


def with_next(df: DataFrame, by: Sequence[str], order: Sequence[Column | str],
              following: Mapping[str, str]) -> DataFrame:
    """Add ``output: column`` of the next row in the group (``lead``), NULL on the last row.

    The next row is in the same slice, or it is the first row of the next slice that has rows:
    one row per slice, which is broadcast.
    """
    placed = _by_group(df, by, order)
    values = F.struct(*[F.col(column).alias(out) for out, column in following.items()])
    here = F.lead(values).over(Window.partitionBy("_slice", "_key").orderBy("_placed"))
    first = placed.groupBy("_slice").agg(F.min_by(F.struct(F.col("_key"), values.alias("_values")), "_placed").alias("_first"))
    # One row per slice: this window and the broadcast are bounded by the slice count.
    after = first.select("_slice", F.lead("_first").over(Window.orderBy("_slice")).alias("_after"))
    rows = placed.withColumn("_next", here).join(F.broadcast(after), "_slice", "left")
    beyond = F.when(F.col("_key") == F.col("_after._key"), F.col("_after._values"))
    found = rows.withColumn("_next", F.coalesce("_next", beyond))
    return found.withColumns({out: F.col(f"_next.{out}") for out in following}).drop(
        "_slice", "_placed", "_key", "_next", "_after")


def rolling_baseline(runs: DataFrame, by: Sequence[str], order: str, value: str, last: int,
                     name: str) -> DataFrame:
    """Average of ``value`` over the ``last`` runs before each run; one row per run comes in."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(-last, -1)
    return runs.withColumn(name, F.avg(value).over(window))
