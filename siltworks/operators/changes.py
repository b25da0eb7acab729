"""Replay of change logs whose rows say insert, update or delete."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import first_per_key
from .rank import with_next

DELETE = "D"


def require_op(df: DataFrame, op: str = "_op") -> DataFrame:
    if op not in df.columns:
        raise ValueError(f"change log has no {op} column; it has {df.columns}")
    return df


def last_change(log: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The newest change of each key, deletes included."""
    newest_first = [F.col(c).desc_nulls_last() for c in sequence_by]
    return first_per_key(log, keys, newest_first)


def current_rows(log: DataFrame, keys: Sequence[str], sequence_by: Sequence[str],
                 op: str = "_op") -> DataFrame:
    """Current state of the source table: newest change per key, deleted keys left out."""
    latest = last_change(require_op(log, op), keys, sequence_by)
    return latest.where(~F.col(op).eqNullSafe(DELETE)).drop(op)


def version_history(log: DataFrame, keys: Sequence[str], sequence_by: Sequence[str],
                    op: str = "_op") -> DataFrame:
    """Every version of every key with ``valid_from``, ``valid_to`` and ``is_current``.

    A version ends where the next change of its key begins. A delete ends the version before
    it and is no version itself. The first sequence column is the validity time.
    """
    first = sequence_by[0]
    timed = with_next(require_op(log, op), keys, list(sequence_by), {"valid_to": first})
    last_seen = F.col("valid_to").isNull()
    return (timed.where(~F.col(op).eqNullSafe(DELETE))
            .withColumns({"valid_from": F.col(first), "is_current": last_seen})
            .drop(op))


def overlapping_versions(history: DataFrame, keys: Sequence[str], valid_from: str = "valid_from",
                         valid_to: str = "valid_to") -> DataFrame:
    """Versions that end after the next version of their key begins, or never end before it."""
    return with_next_start(history, keys, valid_from, valid_to).where(overlaps_next(valid_to)).drop("_next_from")


def with_next_start(history: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str) -> DataFrame:
    """Add ``_next_from``, where the next version of a key begins."""
    return with_next(history, keys, [F.col(valid_from), F.col(valid_to).asc_nulls_last()], {"_next_from": valid_from})


def overlaps_next(valid_to: str) -> Column:
    open_ended = F.col(valid_to).isNull() | (F.col(valid_to) > F.col("_next_from"))
    return F.col("_next_from").isNotNull() & open_ended
