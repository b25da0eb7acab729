"""A bit table of ids, so that rows of a few ids are told from the rest without a shuffle.

The table has a fixed size whatever the number of ids. It never misses an id; what it lets through
in error is left to an exact join of those few rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import give_back, rows_of
from .wordhash import mix

BITS = 24
_SLICES = 64
_PART = pa.schema([("slice", pa.int32()), ("bits", pa.binary())])


def _places(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(np.int64).view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def _bit(places: np.ndarray) -> np.ndarray:
    """A place's bit in its byte, as ``packbits`` has it."""
    return np.uint8(128) >> (places & 7).astype(np.uint8)


def _valid(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    keys = keys.cast(pa.int64())
    return keys.fill_null(0).to_numpy(zero_copy_only=False), keys.is_valid().to_numpy(zero_copy_only=False)


class BitTable:
    def __init__(self, packed: bytes):
        self.bits = np.frombuffer(zlib.decompress(packed), np.uint8)

    def among(self, keys: pa.Array) -> np.ndarray:
        """Whether each id may be one of the table's; null is none."""
        values, valid = _valid(keys)
        places = _places(values)
        return (self.bits[places >> 3] & _bit(places) > 0) & valid


def bit_table(ids: DataFrame) -> bytes:
    """The table of a one-column frame of ids, compressed. Tasks mark bits, slices of which are
    joined; the driver holds ``2**BITS`` bits."""
    span = (1 << BITS) // _SLICES
    schema = "slice int, bits binary"

    def row(k: int, bits: np.ndarray) -> pa.RecordBatch:
        packed = zlib.compress(bits.tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([packed], pa.binary())], schema=_PART)

    def mark(batches):
        bits = np.zeros((1 << BITS) // 8, np.uint8)
        for batch in batches:
            values, valid = _valid(batch.column(0))
            places = _places(values[valid])
            np.bitwise_or.at(bits, places >> 3, _bit(places))
        for k in range(_SLICES):
            part = bits[k * span // 8:(k + 1) * span // 8]
            if part.any():
                yield row(k, part)
        del bits
        give_back()

    def join(batches):
        found: dict[int, np.ndarray] = {}
        for k, packed in rows_of(batches):
            bits = np.frombuffer(zlib.decompress(packed), np.uint8)
            found[k] = found[k] | bits if k in found else bits
        for k, bits in found.items():
            yield row(k, bits)

    table = np.zeros((1 << BITS) // 8, np.uint8)
    marked = ids.mapInArrow(mark, schema).repartition("slice")
    for k, packed in marked.mapInArrow(join, schema).collect():  # 64 slices of a fixed table
        table[k * span // 8:(k + 1) * span // 8] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return zlib.compress(table.tobytes(), 1)


def split(df: DataFrame, id_column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose id is certainly none of ``ids``, and the others, with all their columns."""
    packed, place = bit_table(ids), df.columns.index(id_column)

    def keep(hit: bool):
        def run(batches):
            table = BitTable(packed)
            for batch in batches:
                yield batch.filter(pa.array(table.among(batch.column(place)) == hit))
            del table
            give_back()

        return df.mapInArrow(run, df.schema)

    return keep(False), keep(True)
