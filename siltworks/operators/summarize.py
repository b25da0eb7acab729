"""Grouped aggregates. Every one combines on the map side before its single shuffle."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import steady_round


def spread_summary(df: DataFrame, keys: Sequence[str], value: str, prefix: str = "daily",
                   count_name: str = "reading_count", digits: int = 4) -> DataFrame:
    """Rounded average, maximum, minimum, sample deviation and non-null count per key."""
    stats = {"avg": F.avg, "max": F.max, "min": F.min, "stddev": F.stddev}
    return df.groupBy(*keys).agg(
        *[steady_round(fn(value), digits).alias(f"{prefix}_{name}") for name, fn in stats.items()],
        F.count(value).alias(count_name))


_AGGREGATES = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}


def adaptive_summary(df: DataFrame, keys: Sequence[str],
                     measures: Mapping[str, tuple[str, str]], count_name: str) -> DataFrame:
    """Group by the keys that exist and add each ``output: (aggregate, column)`` whose column exists."""
    present = set(df.columns)
    aggregates = [F.count(F.lit(1)).alias(count_name)]
    aggregates += [_AGGREGATES[how](column).alias(name)
                   for name, (how, column) in measures.items() if column in present]
    return df.groupBy(*[k for k in keys if k in present]).agg(*aggregates)


def op_breakdown(tables: Mapping[str, DataFrame], op_column: str = "_op") -> DataFrame:
    """Rows per change kind of each table and the table's total, in one pass over each table.

    The total sums the few rows that the grouped count leaves. A table without the column is
    counted under a NULL kind.
    """
    tagged = []
    for name, df in tables.items():
        op = F.col(op_column) if op_column in df.columns else F.lit(None).cast("string")
        tagged.append(df.select(F.lit(name).alias("table_name"), op.alias("op")))
    if not tagged:
        raise ValueError("no tables to count")
    counts = (reduce(DataFrame.unionAll, tagged)
              .groupBy("table_name", "op").agg(F.count(F.lit(1)).alias("op_rows")))
    # A table has few kinds of change, so few rows meet in one window.
    return counts.withColumn("total_rows", F.sum("op_rows").over(Window.partitionBy("table_name")))


def count_where(df: DataFrame, condition: Column | str, name: str) -> DataFrame:
    return df.where(condition).agg(F.count(F.lit(1)).alias(name))
