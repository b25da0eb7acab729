"""Typing, filtering and de-duplicating rows."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import typed


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast the listed columns that exist, all in one projection."""
    present = {c: typed(c, t, strict) for c, t in types.items() if c in df.columns}
    return df.withColumns(present) if present else df


def keep_members(df: DataFrame, column: str, members: Sequence | DataFrame) -> DataFrame:
    """Rows whose ``column`` is in ``members``.

    A Python list becomes an IN predicate that reaches the scan. A one-column DataFrame is for
    member sets too large for that and becomes a semi join.
    """
    if isinstance(members, DataFrame):
        key = members.columns[0]
        return df.join(members.select(F.col(key).alias(column)), column, "left_semi")
    return df.filter(F.col(column).isin(list(members)))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``.

    The ``= 1`` filter lets Spark cut every map task to one row per key before the shuffle
    (WindowGroupLimit), so a key with a third of all rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def drop_repeats(df: DataFrame, keys: Sequence[str],
                 order: Sequence[Column | str] | None = None) -> DataFrame:
    """De-duplicate by key; without ``order`` any of the equal-key rows may survive."""
    return first_per_key(df, keys, order) if order else df.dropDuplicates(list(keys))
