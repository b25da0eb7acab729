"""Take files into bronze tables in batches that are bound to a schema before they are read.

The stream carries only the paths of new files. A micro-batch first enters its files in the register,
then looks at them (footers of Parquet, headers of CSV, values of JSON), binds each table to one schema
version that knows all their columns, enters that too, and only then reads them under that schema. A
file with a new column is thus never read under an older schema, whenever it lands and however long
the stream has been running.

One stream can feed many tables: a file's name picks its table, all tables of a batch are looked at
and written side by side, and a table that fails leaves the others alone: its files stay open in the
register and are tried again by the next run. A batch that is repeated after a crash asks the register
what is done. Only for an open batch of an earlier run is the table itself asked which files it holds,
and of it only the data files written since the batch was planned.
"""

from __future__ import annotations

import hashlib
import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import Reading
from ..sinks.tables import append_table, keeps_files
from ..sources.register import FileRegister, named, without
from ..sources.schemas import infer_schema, widen
from .landing import NEVER
from .rescue import conforming_rows

logger = logging.getLogger(__name__)

# The schema of the binary file source; only ``path`` is used, so contents are not read.
_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
#: A store's clock may round to seconds.
_SLACK_MS = 5_000


@dataclass(frozen=True)
class Target:
    """A bronze table; ``lineage`` adds columns while rows are still bound to their files."""

    table: str
    lineage: Callable[[DataFrame], DataFrame]
    renames: Mapping[str, str] = field(default_factory=dict)


def _plain(spark: SparkSession, paths: list[str], known: T.StructType | None, target: Target,
           reading: Reading) -> tuple[DataFrame, T.StructType]:
    """Rows of files whose types agree with the table's, under a schema that knows all their columns."""
    schema = known
    if known is None or reading.evolve:
        found = infer_schema(spark, paths, reading.format, reading.all_options) or T.StructType([])
        try:
            schema = found if known is None else widen(known, found)
        except ValueError as error:  # the message shows the first of the files
            raise ValueError(f"files disagree on column types: {error}; new files: {', '.join(sorted(paths)[:20])}") from error
    if not schema.fields:
        raise ValueError(f"no {reading.format} columns in {', '.join(sorted(paths)[:20])}")
    rows = spark.read.format(reading.format).schema(schema).options(**reading.all_options).load(paths)
    return target.lineage(rows), schema


def _rescued(spark: SparkSession, paths: list[str], known: T.StructType | None, target: Target,
             reading: Reading) -> tuple[DataFrame, T.StructType]:
    """Rows of files of any types; values that don't fit are kept in the rescue column."""
    return conforming_rows(named(paths, spark), known or T.StructType([]), target.lineage, reading)


def held_files(spark: SparkSession, table: str, since: int | None, file_column: str = "_source_file") -> DataFrame:
    """``file_path`` of the files whose rows were written to a table since a moment (in milliseconds);
    data files that are older are not read."""
    rows = spark.table(table)
    if since is not None and keeps_files(spark):
        rows = rows.where(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(since - _SLACK_MS)))
    return rows.select(F.col(file_column).alias("file_path")).distinct()


class Intake:
    """Batches of one register. ``target`` gives the table for a name that files are grouped by."""

    def __init__(self, spark: SparkSession, register: FileRegister, target: Callable[[str], Target], reading: Reading,
                 at_once: int = 8, file_column: str = "_source_file"):
        if reading.rescues and reading.format not in ("parquet", "csv", "json"):
            raise ValueError(f"values of {reading.format} files can't be rescued")
        self.spark, self.register, self.target, self.reading = spark, register, target, reading
        self.at_once, self.file_column = at_once, file_column
        self.errors: dict[str, Exception] = {}

    def open_batches(self) -> None:
        """Finish what earlier runs have planned and not done."""
        waiting: dict[str, list[str]] = {}
        for batch, name in self.register.unfinished():
            waiting.setdefault(batch, []).append(name)
        for batch, names in waiting.items():
            self.take(batch, names, repeated=True)

    def plan(self, batch: str, files: DataFrame, known: bool) -> list[str]:
        """Enter a batch, without files that the register has where ``known``; the tables it feeds."""
        self.register.plan(batch, without(files, self.register.planned()) if known else files)
        return self.register.names(batch)

    def _left(self, batch: str, name: str, target: Target, repeated: bool) -> list[str]:
        """Paths whose rows are not in the table yet; a batch's files are few enough for a list."""
        files = self.register.files(batch, name)
        if repeated and self.spark.catalog.tableExists(target.table):
            files = without(files, held_files(self.spark, target.table, self.register.planned_since(batch), self.file_column))
        return [row.path for row in files.select("path").toLocalIterator()]

    def _each(self, names: Iterable[str], work: Callable[[str], object]) -> dict[str, object]:
        """The results of ``work`` for the names that it does not fail for."""
        failed = set()

        def guarded(name: str):
            try:
                return name, work(name)
            except Exception as error:  # a bad table must not stop the others
                logger.exception("files of %s were not taken in", name or "a table")
                self.errors[name] = error
                failed.add(name)
                return name, None

        with ThreadPoolExecutor(max_workers=max(1, self.at_once)) as pool:
            results = list(pool.map(guarded, names))
        return {name: result for name, result in results if name not in failed}

    def take(self, batch: str, names: list[str], repeated: bool = False) -> None:
        """Bind the tables of a planned batch, read its files and append their rows."""
        known = self.register.schemas()
        read = _rescued if self.reading.rescues else _plain

        def bind(name: str) -> tuple[DataFrame, T.StructType] | None:
            target = self.target(name)
            paths = self._left(batch, name, target, repeated)
            return read(self.spark, paths, known.get(name, (0, None))[1], target, self.reading) if paths else None

        found = self._each(names, bind)
        bound = {}
        for name, result in found.items():
            if result is not None:
                version, schema = known.get(name, (0, None))
                bound[name] = (version if schema == result[1] else version + 1, result[1])
        if bound:
            self.register.bind(batch, bound)

        def append(name: str) -> bool:
            if found[name] is not None:
                target = self.target(name)
                append_table(found[name][0].withColumnsRenamed(dict(target.renames)), target.table)
            return True

        done = self._each(found, append)
        if done:
            self.register.finish(batch, done)


def intake_stream(spark: SparkSession, path: str, checkpoint: str, register: FileRegister,
                  target: Callable[[str], Target], reading: Reading = Reading(), every: str | None = None,
                  name_glob: str | None = None, name: Column | None = None, at_once: int = 8,
                  errors: dict[str, Exception] | None = None) -> StreamingQuery:
    """Start taking in all files below ``path`` (or those whose name matches).

    ``name`` is the table name that a file's ``path`` stands for. Errors of tables go to ``errors``;
    without it the first one ends the stream. By default everything landed so far is taken in and
    the query stops; with ``every`` it keeps running at that interval.
    """
    intake = Intake(spark, register, target, reading, at_once)
    if errors is not None:
        intake.errors = errors
    source = (spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
              .option("recursiveFileLookup", "true").option("maxFileAge", NEVER)
              .option("maxFilesPerTrigger", str(reading.files_per_batch)))
    if name_glob:
        source = source.option("pathGlobFilter", name_glob)
    found = source.load(path).select("path", F.col("_metadata.file_path").alias("file_path"),
                                     (F.lit("") if name is None else name).alias("table_name"))
    writer_id = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    state = {"first": True}

    def raise_first() -> None:
        if errors is None and intake.errors:
            raise next(iter(intake.errors.values()))

    def take_in(batch: DataFrame, batch_id: int) -> None:
        label = f"{writer_id}-{batch_id:09d}"
        first, state["first"] = state["first"], False
        if first and register.is_planned(label):
            return  # open_batches has finished it
        names = intake.plan(label, batch, known=first)
        if names:
            intake.take(label, names)
        raise_first()

    if register.exists():
        intake.open_batches()
    raise_first()
    writer = found.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
