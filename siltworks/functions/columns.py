"""Column expressions shared by the cleaning steps; all stay inside generated JVM code."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def typed(value: Column | str, type_name: str, strict: bool = False) -> Column:
    """Cast; text that does not fit becomes NULL, or fails the job when ``strict``."""
    column = _col(value)
    return column.cast(type_name) if strict else column.try_cast(type_name)


def to_moment(value: Column | str, strict: bool = False, zone: str | None = None) -> Column:
    """Text or date to timestamp; ``zone`` is the zone that a text without an offset means."""
    moment = typed(value, "timestamp", strict)
    return F.to_utc_timestamp(moment, zone) if zone else moment


def to_day(value: Column | str, strict: bool = False) -> Column:
    return typed(value, "date", strict)


def from_epoch_or_text(name: str, is_epoch: bool, strict: bool = False) -> Column:
    """Timestamp from epoch seconds or from text."""
    if is_epoch:
        return F.timestamp_seconds(typed(name, "bigint", strict))
    return to_moment(name, strict)


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``n / d``, NULL unless the denominator is above zero."""
    bottom = _col(denominator)
    return F.when(bottom > 0, _col(numerator) / bottom)


def steady_round(value: Column | str, digits: int) -> Column:
    """Half-up rounding that does not depend on the order in which doubles were added.

    The last bits of a sum differ with the order of its parts, which decides values that lie
    halfway. Rounding to ten digits first takes those bits away.
    """
    return F.round(F.round(_col(value), 10), digits)


def has_text(value: Column | str) -> Column:
    column = _col(value)
    return column.isNotNull() & (F.length(column) > 0)


def any_present(names: Sequence[str]) -> Column:
    """True where at least one of the columns is not NULL."""
    return reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names])


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions)
