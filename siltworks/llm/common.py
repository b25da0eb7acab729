"""Helpers that the operators share: streaming Arrow batches in and out of tasks."""

from __future__ import annotations

import ctypes
import sys
import types
from typing import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A task hands results on when it holds this many bytes or rows of them.
FLUSH_BYTES = 4 << 20
FLUSH_ROWS = 4096


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as Python tuples, a small slice in memory at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield from zip(*(column.to_pylist() for column in part.columns))


class Sink:
    """Collects rows and turns them into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, weight: int = 64) -> bool:
        """True when :meth:`flush` is due."""
        self.rows.append(row)
        self.bytes += weight
        return self.bytes >= FLUSH_BYTES or len(self.rows) >= FLUSH_ROWS

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, self.schema)]
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _kept() -> dict:
    """What :func:`per_process` keeps. Task functions travel by value, so the globals of their modules end with the task."""
    return sys.modules.setdefault("_siltworks_kept", types.ModuleType("_siltworks_kept")).__dict__.setdefault("values", {})


def per_process(key: tuple, make: Callable):
    """A value made once in a worker process and kept for later tasks, until a task gives it back."""
    store = _kept()
    if key not in store:
        store[key] = make()
    return store[key]


def give_back(*keep: str) -> None:
    """Return the memory that a finished task has freed, for its worker waits for others and keeps it:
    Arrow's buffers and, where the C library can, what lies between its blocks.

    Workers serve all stages of a session, so values of :func:`per_process` go too, but those whose
    keys begin with a name in ``keep``.
    """
    store = _kept()
    for key in [key for key in store if key[0] not in keep]:
        del store[key]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def whole_text(column: str):
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def by_columns(df: DataFrame, **wanted) -> DataFrame:
    """Only the named expressions, so that further columns of any name cannot clash."""
    return df.select(*(expression.alias(name) for name, expression in wanted.items()))
