"""Infer, remember and widen the schema of landed files."""

from __future__ import annotations

import json
from typing import Iterator, Mapping, Sequence

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import arrow_location, list_files, path_missing


def infer_schema(spark: SparkSession, path: str | Sequence[str], file_format: str,
                 options: Mapping[str, str] | None = None) -> T.StructType | None:
    """Merged schema of all files at ``path``; None when there are none.

    For Parquet and ORC this reads footers in a distributed job, for text formats the text.
    """
    reader = (spark.read.format(file_format).option("mergeSchema", "true")
              .option("header", "true").option("inferSchema", "true").options(**(options or {})))
    try:
        return reader.load(path).schema
    except AnalysisException as error:
        if path_missing(error) or (error.getCondition() or "") == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
    except Py4JJavaError as error:  # Spark leaves a failed merge of footers in this form
        if file_format == "parquet" and "CANNOT_MERGE" in str(error):
            raise ValueError(_conflict_message(spark, path, options)) from error
        raise


def _conflict_message(spark: SparkSession, path: str | Sequence[str], options: Mapping[str, str] | None) -> str:
    """Name the files to look at; the message shows the first few."""
    if isinstance(path, str):
        files = list_files(spark, path, (options or {}).get("pathGlobFilter", "*.parquet"))
    else:
        files = spark.createDataFrame([(p,) for p in path], "path string")
    rows = conflicting_files(files).orderBy("path").limit(20).collect()
    return "files disagree on column types: " + "; ".join(
        f"{r.path} has {r.column} as {r.type}, others as {r.usual_type}" for r in rows)


class SchemaLog:
    """Schema versions kept as small JSON files beside a checkpoint, and the files they were taken from."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location

    def _newest(self) -> tuple[int, str] | None:
        try:
            versions = self.spark.read.schema("version int, body string").json(self.location)
        except AnalysisException as error:
            if path_missing(error):
                return None
            raise
        # One short row per schema change.
        return max(((row.version, row.body) for row in versions.collect()), default=None)

    def latest(self) -> T.StructType | None:
        newest = self._newest()
        return None if newest is None else T.StructType.fromJson(json.loads(newest[1]))

    def add(self, schema: T.StructType) -> None:
        newest = self._newest()
        row = [(0 if newest is None else newest[0] + 1, schema.json())]
        self.spark.createDataFrame(row, "version int, body string").coalesce(1).write.mode(
            "append").json(self.location)


    def unread(self, listing: DataFrame) -> DataFrame:
        """Paths of a listing from which no version has been taken yet."""
        try:
            known = self.spark.read.schema("path string").parquet(f"{self.location}_files")
        except AnalysisException as error:
            if path_missing(error):
                return listing.select("path")
            raise
        return listing.select("path").join(known, "path", "left_anti")

    def read(self, paths: Sequence[str]) -> None:
        """Remember that these files have been looked at."""
        self.spark.createDataFrame([(p,) for p in paths], "path string").write.mode("append").parquet(f"{self.location}_files")


def widen(stored: T.StructType, found: T.StructType) -> T.StructType:
    """``stored`` plus the columns only ``found`` has; a changed type of a known column is an error."""
    known = {f.name.lower(): f for f in stored.fields}
    clashes = [f"{f.name}: {known[f.name.lower()].dataType.simpleString()} -> {f.dataType.simpleString()}"
               for f in found.fields
               if f.name.lower() in known and known[f.name.lower()].dataType != f.dataType]
    if clashes:
        raise ValueError("column types changed: " + ", ".join(clashes))
    added = [T.StructField(f.name, f.dataType, True) for f in found.fields
             if f.name.lower() not in known]
    return T.StructType(list(stored.fields) + added)


def remembered_schema(spark: SparkSession, log: SchemaLog, path: str, file_format: str,
                      evolve: bool = True, options: Mapping[str, str] | None = None,
                      listing: DataFrame | None = None) -> T.StructType | None:
    """Stored schema, widened by new columns of files not looked at before, and stored if it grew.

    Only those files are opened, so a run's work follows what has landed since the last one.
    ``listing`` (``list_files``) spares listing ``path`` again. With ``evolve=False`` a stored
    schema is returned without looking at the files.
    """
    stored = log.latest()
    if stored is not None and not evolve:
        return stored
    if listing is None:
        listing = list_files(spark, path, (options or {}).get("pathGlobFilter"))
    if listing is None:
        return stored
    paths = [row.path for row in log.unread(listing).toLocalIterator()]  # the reader needs their names
    if not paths:
        return stored
    own = {k: v for k, v in (options or {}).items() if k not in ("pathGlobFilter", "recursiveFileLookup")}
    found = infer_schema(spark, paths, file_format, own)
    if found is None:
        return stored
    try:
        current = found if stored is None else widen(stored, found)
    except ValueError as error:  # the message shows the first of the new files
        raise ValueError(f"files disagree on column types: {error}; new files: {', '.join(sorted(paths)[:20])}") from error
    if stored is None or len(current) > len(stored):
        log.add(current)
    log.read(paths)
    return current


def parquet_columns(files: DataFrame, path: str = "path") -> DataFrame:
    """``path, column, type`` from the footer of every listed Parquet file.

    Executors read the footers, a batch of paths at a time. Use it to find the files behind a
    type conflict, which a merged read only reports as an error.
    """
    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            for uri in batch[path]:
                filesystem, name = arrow_location(uri)
                schema = pq.read_schema(name, filesystem=filesystem)
                yield pd.DataFrame({"path": uri, "column": schema.names,
                                    "type": [str(t) for t in schema.types]})

    return files.select(path).mapInPandas(footers, "path string, column string, type string")


def conflicting_files(files: DataFrame) -> DataFrame:
    """Files holding a column in another type than most files do: ``path, column, type, usual_type``.

    Among equally common types the one of the first path counts as usual.
    """
    columns = parquet_columns(files)
    votes = columns.groupBy("column", "type").agg(F.count(F.lit(1)).alias("files"),
                                                  F.min("path").alias("first_path"))
    rank = F.struct(-F.col("files"), F.col("first_path"))
    usual = votes.groupBy("column").agg(F.min_by("type", rank).alias("usual_type"),
                                        F.count(F.lit(1)).alias("types"))
    return (columns.join(usual.where("types > 1").drop("types"), "column")
            .where("type <> usual_type").select("path", "column", "type", "usual_type"))
