"""File streams and their bronze sinks."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import FILES_PER_BATCH
from ..sinks.tables import add_columns, table_format
from ..sources.files import partition_glob

# A file source passes over files that are a week older than the newest one it knows, so that a
# late or restored folder would be lost. With this limit it takes in files of any age, and
# remembers the name of every file it has taken in.
NEVER = "36500d"


def file_stream(spark: SparkSession, path: str, file_format: str, schema: T.StructType,
                options: Mapping[str, str] | None = None) -> DataFrame:
    """Stream of the files below ``path``, those already there included, each read once.

    A micro-batch takes at most ``FILES_PER_BATCH`` files unless ``options`` says otherwise.
    """
    reader = spark.readStream.format(file_format).schema(schema)
    defaults = {"recursiveFileLookup": "true", "maxFileAge": NEVER,
                "maxFilesPerTrigger": str(FILES_PER_BATCH)}
    return reader.options(**{**defaults, **(options or {})}).load(path)


def partition_stream(spark: SparkSession, root: str, file_format: str, schema: T.StructType,
                     options: Mapping[str, str] | None = None, **choices: Iterable) -> DataFrame:
    """Stream of the chosen folders of a partitioned tree; partition values become columns."""
    reader = (spark.readStream.format(file_format).schema(schema).option("basePath", root)
              .option("maxFileAge", NEVER).option("maxFilesPerTrigger", str(FILES_PER_BATCH)))
    return reader.options(**(options or {})).load(partition_glob(root, **choices))


def distinct_stream(stream: DataFrame, keys: Sequence[str], event_time: str | None = None,
                    horizon: str | None = None) -> DataFrame:
    """The first row of each key that the stream ever brings, over all runs of one checkpoint.

    Keys that have been seen are kept in Spark's state store, dealt out by key, so that neither the
    source nor the table is read again; a key with very many rows is cut to one row per task first. With
    ``event_time`` and ``horizon`` a key is forgotten when that much time has passed since; rows older
    than that are late and left out, so choose the horizon longer than repeats and late files take.
    Without them no row is ever late and the state grows with the number of keys: give the session the
    RocksDB state store then.
    """
    if (event_time is None) != (horizon is None):
        raise ValueError("a horizon needs an event time")
    if event_time is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(keys))


def append_stream(stream: DataFrame, table: str, checkpoint: str,
                  every: str | None = None) -> StreamingQuery:
    """Start appending ``stream`` to ``table``.

    By default everything landed so far is taken in and the query stops; with ``every`` it
    keeps running at that interval. New columns are added to an existing table first: the
    catalog would not show them otherwise.
    """
    spark = stream.sparkSession
    if spark.catalog.tableExists(table):
        add_columns(spark, table, stream.schema)
    writer = (stream.writeStream.format(table_format(spark)).outputMode("append")
              .option("checkpointLocation", checkpoint).option("mergeSchema", "true"))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.toTable(table)
