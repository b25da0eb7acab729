"""Joins on grouping keys, where NULL equals NULL as it does in a GROUP BY."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def renamed_keys(by: Sequence[str]) -> list[Column]:
    """The key columns under names that cannot clash with those of the other side."""
    return [F.col(c).alias(f"_by_{c}") for c in by]


def same_key(left: DataFrame, right: DataFrame, by: Sequence[str]) -> Column:
    """Null-safe equality with a side whose keys are :func:`renamed_keys`."""
    return reduce(and_, [left[c].eqNullSafe(right[f"_by_{c}"]) for c in by])


def drop_renamed(df: DataFrame, by: Sequence[str], *others: str) -> DataFrame:
    return df.drop(*[f"_by_{c}" for c in by], *others)


def split_by_keys(df: DataFrame, keys: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not in ``keys``, and rows whose key is; ``keys`` holds renamed keys."""
    match = same_key(df, keys, by)
    return df.join(keys, match, "left_anti"), df.join(keys, match, "left_semi")
