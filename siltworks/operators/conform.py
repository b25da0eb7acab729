"""Bring tables with unknown column names to one shape."""

from __future__ import annotations

from typing import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE_ENDINGS = ("date", "datetime", "timestamp", "time")


def plain_name(name: str) -> str:
    """Lower case, letters and digits only."""
    return "".join(filter(str.isalnum, name.lower()))


def resolve_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """The column that the first matching candidate names, compared by plain name.

    Two columns with one plain name: the later one wins.
    """
    by_plain = {plain_name(c): c for c in columns}
    return next((by_plain[p] for p in map(plain_name, candidates) if p in by_plain), None)


def resolve_synonyms(columns: Sequence[str],
                     synonyms: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """target -> source column, for every target that some column matches."""
    found = {target: resolve_column(columns, names) for target, names in synonyms.items()}
    return {target: source for target, source in found.items() if source is not None}


def select_synonyms(df: DataFrame, synonyms: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename matched columns to their targets and drop the others."""
    found = resolve_synonyms(df.columns, synonyms)
    return df.select([F.col(f"`{source}`").alias(target) for target, source in found.items()])


def find_date_column(columns: Sequence[str], exclude: Collection[str] = ()) -> str | None:
    """First column not starting with ``_`` that is named like a date; ``exclude`` holds plain names."""
    for column in columns:
        plain = plain_name(column)
        if not column.startswith("_") and plain not in exclude and plain.endswith(DATE_ENDINGS):
            return column
    return None
