"""Which files has a table taken in, in which batch, and under which schema?

A register is a folder that only grows. A batch of files leaves three marks there, each one write:

* ``planned``: the files of the batch and the table each belongs to, before anything is read,
* ``bound``: the schema version that each table reads them with, before they are read,
* ``done``: the tables that have them, after the rows are in.

A batch that is planned and not done is open: whoever comes next finishes it. Rows are a few per batch
and one per file, so questions about files never read the tables.
"""

from __future__ import annotations

import json
from typing import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .discovery import database_location
from .files import path_missing, root_exists

_PLANNED = "batch string, table_name string, path string, file_path string"
_BOUND = "batch string, table_name string, version int, body string"
_DONE = "batch string, table_name string"


class FileRegister:
    """The register at ``location``. ``table_name`` is empty where one table has a register of its own."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    @classmethod
    def beside(cls, spark: SparkSession, table: str, name: str | None = None) -> "FileRegister":
        """The register of a table, in a folder of its database that is no table itself."""
        *parent, own = table.split(".")
        return cls(spark, f"{database_location(spark, '.'.join(parent))}/_registers/{name or own}")

    def _read(self, kind: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.location}/{kind}")
        except AnalysisException as error:
            if path_missing(error):
                return self.spark.createDataFrame([], schema)
            raise

    def _write(self, rows: DataFrame, kind: str, batch: str) -> None:
        # a folder per batch: a write that is repeated replaces its own rows and no others
        rows.drop("batch").write.mode("overwrite").parquet(f"{self.location}/{kind}/batch={batch}")

    def _path(self, kind: str, batch: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.location}/{kind}/batch={batch}/_SUCCESS")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _since(self, kind: str, batch: str) -> int | None:
        """When this mark was made, in milliseconds of the store's clock."""
        path, files = self._path(kind, batch)
        return files.getFileStatus(path).getModificationTime() if files.exists(path) else None

    # --- marks

    def plan(self, batch: str, files: DataFrame) -> None:
        """``files`` has ``path, file_path`` and, where tables share the register, ``table_name``."""
        name = F.col("table_name") if "table_name" in files.columns else F.lit("")
        self._write(files.select(name.alias("table_name"), "path", "file_path"), "planned", batch)

    def bind(self, batch: str, schemas: Mapping[str, tuple[int, T.StructType]]) -> None:
        rows = [(name, version, schema.json()) for name, (version, schema) in schemas.items()]
        self._write(self.spark.createDataFrame(rows, _BOUND.split(", ", 1)[1]).coalesce(1), "bound", batch)

    def finish(self, batch: str, names: Iterable[str] = ("",)) -> None:
        """Add ``names`` to those that have the batch. What is there already stays."""
        have = {r.table_name for r in self.done().where(F.col("batch") == batch).collect()} if self._since("done", batch) else set()
        rows = [(name,) for name in sorted(have | set(names))]
        self._write(self.spark.createDataFrame(rows, "table_name string").coalesce(1), "done", batch)

    # --- questions

    def exists(self) -> bool:
        return root_exists(self.spark, self.location)

    def is_planned(self, batch: str) -> bool:
        return self._since("planned", batch) is not None

    def planned(self) -> DataFrame:
        """``batch, table_name, path, file_path`` of all files, taken in or not."""
        return self._read("planned", _PLANNED)

    def done(self) -> DataFrame:
        return self._read("done", _DONE)

    def taken(self) -> DataFrame:
        """``batch, table_name, path, file_path`` of the files whose rows are in their table."""
        return self.planned().join(self.done(), ["batch", "table_name"], "left_semi")

    def unfinished(self) -> list[tuple[str, str]]:
        """``(batch, table_name)`` of what was planned and isn't done, oldest first: batches that crashed or failed."""
        waiting = self.planned().select("batch", "table_name").distinct().join(self.done(), ["batch", "table_name"], "left_anti")
        return sorted((r.batch, r.table_name) for r in waiting.collect())

    def files(self, batch: str, name: str = "") -> DataFrame:
        """``path, file_path`` that a batch holds for one table."""
        rows = self.spark.read.schema(_PLANNED.split(", ", 1)[1]).parquet(f"{self.location}/planned/batch={batch}")
        return rows.where(F.col("table_name") == name).select("path", "file_path")

    def names(self, batch: str) -> list[str]:
        rows = self.spark.read.schema("table_name string").parquet(f"{self.location}/planned/batch={batch}")
        return sorted(r.table_name for r in rows.distinct().collect())

    def planned_since(self, batch: str) -> int | None:
        return self._since("planned", batch)

    def schemas(self) -> dict[str, tuple[int, T.StructType]]:
        """The newest schema version of each table; one row per table comes to the driver."""
        newest = self._read("bound", _BOUND).groupBy("table_name").agg(
            F.max("version").alias("version"), F.max_by("body", "version").alias("body"))
        return {r.table_name: (r.version, T.StructType.fromJson(json.loads(r.body))) for r in newest.collect()}

    # --- tables that were filled without a register

    def seed(self, table: DataFrame, file_column: str = "_source_file") -> None:
        """Enter the files that the rows of a table name, once, when the register begins."""
        paths = table.select(F.col(file_column).alias("file_path")).where("file_path IS NOT NULL").distinct()
        self.plan("seed", paths.withColumn("path", F.col("file_path")))
        self.finish("seed")

    def clear(self) -> None:
        """Forget everything: the table's rows have been replaced."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.location)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def without(files: DataFrame, known: DataFrame, column: str = "file_path") -> DataFrame:
    """``files`` that ``known`` does not name."""
    return files.join(known.select(column).distinct(), column, "left_anti")


def named(paths: Sequence[str], spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p,) for p in paths], "path string")
