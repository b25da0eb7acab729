"""Labels by threshold."""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


class Bound(NamedTuple):
    """``label`` applies when ``value <op> limit``."""

    op: str
    limit: float
    label: str


_TESTS = {
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}


def tier(value: Column | str, bounds: Sequence[Bound], otherwise: str,
         applies: Column | None = None, null_label: str | None = None,
         label_nulls: bool = False) -> Column:
    """First bound that holds gives the label, else ``otherwise``.

    Rows where ``applies`` is false get NULL. A NULL value fails every bound and so gets
    ``otherwise``, unless ``label_nulls`` asks for ``null_label``.
    """
    column = F.col(value) if isinstance(value, str) else value
    steps = []
    if applies is not None:
        steps.append((~applies, F.lit(None).cast("string")))
    if label_nulls:
        steps.append((column.isNull(), F.lit(null_label).cast("string")))
    steps += [(_TESTS[b.op](column, F.lit(b.limit)), F.lit(b.label)) for b in bounds]
    chain = F
    for condition, label in steps:
        chain = chain.when(condition, label)
    return chain.otherwise(F.lit(otherwise))
