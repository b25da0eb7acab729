"""Keep the current state of a changing table, batch by batch."""

from __future__ import annotations

from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import DELETE, last_change, require_op
from ..operators.keys import renamed_keys, split_by_keys
from ..sources.files import path_missing
from ..sources.schemas import SchemaLog, widen


class ChangeState:
    """Newest change per key under ``location``, deletes included.

    Each batch adds one folder with its own newest change per key, so the cost of a batch
    follows the batch and not the table. Reading takes the newest change over the base and the
    folders that follow it; :meth:`compact` folds them into the next base. Deletes stay as rows
    with their sequence, so that an older change arriving late cannot bring a key back.

    Folders are grouped by the base they follow. A repeated batch overwrites its own folder,
    and a new base counts only once the line naming it is written: nothing that a reader uses
    is changed in place, and a change that is applied twice changes nothing.

    A column that the log gains later widens the state for good; rows from before have it NULL.
    Folders that no reader of the newest base needs stay until :meth:`vacuum`.
    """

    def __init__(self, spark: SparkSession, location: str, schema: T.StructType,
                 keys: Sequence[str], sequence_by: Sequence[str], op: str = "_op"):
        if op not in schema.fieldNames():
            raise ValueError(f"change schema has no {op} column")
        self.spark, self.location = spark, location.rstrip("/")
        self.log = SchemaLog(spark, f"{self.location}/schema")
        stored = self.log.latest()
        self.schema = schema if stored is None else widen(stored, schema)
        self.keys, self.sequence_by, self.op = list(keys), list(sequence_by), op

    def _base_path(self, version: int) -> str:
        return f"{self.location}/base/v={version}"

    def _changes_path(self, version: int) -> str:
        return f"{self.location}/changes/v={version}"

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Fold in one batch; repeating a batch id replaces its first attempt."""
        wider = widen(self.schema, changes.schema)
        if len(wider) > len(self.schema):
            self.log.add(wider)
            self.schema = wider
        newest = last_change(require_op(changes, self.op), self.keys, self.sequence_by)
        present = set(changes.columns)
        aligned = newest.select(*[
            F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self.schema.fields])
        aligned.write.mode("overwrite").parquet(
            f"{self._changes_path(self.version())}/batch={batch_id}")

    def version(self) -> int:
        """Number of the base in use; 0 before the first."""
        try:
            log = self.spark.read.schema("version int").json(f"{self.location}/bases")
        except AnalysisException as error:
            if path_missing(error):
                return 0
            raise
        return log.agg(F.max("version")).first()[0] or 0

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(self.schema).parquet(path)
        except AnalysisException as error:
            if path_missing(error):
                return None
            raise

    def newest(self) -> DataFrame:
        """Newest change per key over everything applied."""
        version = self.version()
        base = self._read(self._base_path(version)) if version else None
        changes = self._read(self._changes_path(version))
        if changes is None:
            return base if base is not None else self.spark.createDataFrame([], self.schema)
        newest = last_change(changes.select(*self.schema.fieldNames()), self.keys, self.sequence_by)
        if base is None:
            return newest
        # Only base rows whose key has changed take part in the shuffle. The joins broadcast
        # the changed keys while Spark finds them small enough.
        touched = newest.select(*renamed_keys(self.keys))
        untouched, replaced = split_by_keys(base, touched, self.keys)
        return untouched.unionByName(last_change(replaced.unionByName(newest), self.keys, self.sequence_by))

    def current(self) -> DataFrame:
        """The table as it is now: deleted keys are left out."""
        return self.newest().where(~F.col(self.op).eqNullSafe(DELETE)).drop(self.op)

    def compact(self) -> None:
        """Write the next base from this one and the changes that follow it."""
        version = self.version()
        if self._read(self._changes_path(version)) is None:
            return
        self.newest().write.mode("overwrite").parquet(self._base_path(version + 1))
        self.spark.createDataFrame([(version + 1,)], "version int").coalesce(1).write.mode(
            "append").json(f"{self.location}/bases")


    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete the changes that newer bases hold and all but the newest ``keep`` bases; returns
        what was deleted. Call it when no reader uses an older base."""
        if keep < 1:
            raise ValueError("the newest base has to stay")
        jvm = self.spark.sparkContext._jvm
        deleted = []
        for folder, oldest in (("base", self.version() - keep + 1), ("changes", self.version())):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.location}/{folder}")
            files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            for status in files.listStatus(path) if files.exists(path) else ():
                name = status.getPath().getName()
                if name.startswith("v=") and int(name[2:]) < oldest:
                    files.delete(status.getPath(), True)
                    deleted.append(f"{folder}/{name}")
        return sorted(deleted)


def replay_stream(stream: DataFrame, state: ChangeState, checkpoint: str,
                  every: str | None = None, compact_every: int = 50) -> StreamingQuery:
    """Start folding a stream of changes into ``state``."""
    def fold(batch: DataFrame, batch_id: int) -> None:
        state.apply(batch, batch_id)
        if (batch_id + 1) % compact_every == 0:
            state.compact()

    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()

