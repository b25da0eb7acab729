"""The history of a changing table, kept up to date by merging batches of changes.

The stored table has a row for every change of every key, deletes included, with the moment at which
it ends, and is partitioned by a hash of the key. A batch touches the partitions of its keys only, and in
these only the rows of its keys are timed anew: a late change splits the version that it falls into, a
delete closes one, and a newer change closes the open one. A batch may come in any order, late, or
again: rows that are there already add nothing.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import DELETE, require_op
from ..operators.keys import renamed_keys, split_by_keys
from ..operators.rank import with_next
from ..session import stage
from .tables import replace_partitions

PART = "_part"
BUCKETS = 256


class History:
    """``table`` holds the changes of ``keys`` in the order of ``sequence_by``, whose first column is
    the validity time. The number of buckets is fixed when the table is made: size it so that one
    holds 100 to 200 MB."""

    def __init__(self, table: str, keys: Sequence[str], sequence_by: Sequence[str], op: str = "_op", buckets: int = BUCKETS):
        self.table, self.keys, self.sequence_by, self.op, self.buckets = table, list(keys), list(sequence_by), op, buckets

    def _timed(self, log: DataFrame) -> DataFrame:
        return with_next(log, self.keys, self.sequence_by, {"valid_to": self.sequence_by[0]})

    def merge(self, changes: DataFrame) -> None:
        """Merge a batch. Running it again, also after it broke off, changes nothing."""
        spark = changes.sparkSession
        marks = [part for k in self.keys for part in (F.col(k).isNull(), F.col(k))]  # a hash passes over NULLs
        part = F.pmod(F.xxhash64(*marks), F.lit(self.buckets)).cast("int").alias(PART)
        fresh = stage(require_op(changes, self.op).select("*", part).distinct(), "changes")
        touched = [r[0] for r in fresh.select(PART).distinct().collect()]  # at most the number of buckets
        if not touched:
            return
        if not spark.catalog.tableExists(self.table):
            return replace_partitions(self._timed(fresh), self.table, [PART])
        known = spark.table(self.table).where(F.col(PART).isin(touched))
        other, mine = split_by_keys(known, fresh.select(*renamed_keys(self.keys)).distinct(), self.keys)
        log = mine.drop("valid_to").unionByName(fresh, allowMissingColumns=True).distinct()
        # staged, because the partitions that are read are those that are replaced
        merged = stage(other.unionByName(self._timed(log), allowMissingColumns=True), "history")
        replace_partitions(merged, self.table, [PART])

    def versions(self, spark: SparkSession) -> DataFrame:
        """Every version with ``valid_from``, ``valid_to`` and ``is_current``; deletes are none."""
        return (spark.table(self.table).where(~F.col(self.op).eqNullSafe(DELETE))
                .withColumns({"valid_from": F.col(self.sequence_by[0]), "is_current": F.col("valid_to").isNull()})
                .drop(self.op, PART))
