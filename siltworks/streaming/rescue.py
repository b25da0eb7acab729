"""Take in files whose columns and types do not all agree, without losing a value.

A batch of files is grouped by the columns the files say they have (Parquet footers, CSV headers; JSON
names each value) and each group is read as it is: values that fit the table are cast, the others go
to the rescue column as JSON. Text is read as text, so that a number keeps all its digits, and a CSV
record whose fields are more or fewer than the header's is kept as it was written, beside the fields
that it has.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Reading
from ..operators.rescue import RECORD, rescue_types
from ..sources.files import arrow_location
from ..sources.schemas import infer_schema, parquet_columns


def _headers(files: DataFrame) -> DataFrame:
    """``path, types`` of CSV files: the first line, read by the executors."""
    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = []
            for uri in batch["path"]:
                filesystem, name = arrow_location(uri)
                with filesystem.open_input_stream(name) as source:  # inflates by the file's ending
                    line = b""
                    while b"\n" not in line and (block := source.read(4096)):
                        line += block
                lines.append(line.split(b"\n")[0].decode("utf-8", "replace").rstrip("\r"))
            yield pd.DataFrame({"path": batch["path"], "types": lines})

    return files.select("path").mapInPandas(first_lines, "path string, types string")


def _with_line_breaks(files: DataFrame, reading: Reading) -> DataFrame:
    """``path`` of the CSV files in which a quoted field may go on in the next line: a line of theirs has
    an odd number of quotes. These are read whole; all others can be split between tasks."""
    quote = reading.options.get("quote", '"')
    if not quote or "multiLine" in reading.options:
        return files.select("path").limit(0)
    spark, paths = files.sparkSession, [row.path for row in files.select("path").toLocalIterator()]  # those of one batch
    own = {k: v for k, v in reading.options.items() if k in ("lineSep", "compression")}
    lines = spark.read.options(**own).text(paths).select("value", F.col("_metadata.file_path").alias("file_path"))

    def odd(text: Column) -> Column:
        return (F.length(text) - F.length(F.replace(text, F.lit(quote), F.lit("")))) % 2 == 1

    hits = lines.where(odd(F.col("value")) | odd(F.regexp_replace("value", r"\\.", ""))).select("file_path").distinct()
    listed = spark.read.format("binaryFile").load(paths).select("path", F.col("_metadata.file_path").alias("file_path"))
    return listed.join(hits, "file_path", "left_semi").select("path")


def files_by_types(files: DataFrame, reading: Reading = Reading()) -> list[tuple[list[str], bool]]:
    """Paths of the listed files, grouped by the columns (and types) they say they have, and whether their
    records may go over several lines."""
    file_format = reading.format
    if file_format == "parquet":
        types = parquet_columns(files).groupBy("path").agg(
            F.to_json(F.sort_array(F.collect_list(F.struct("column", "type")))).alias("types"))
    elif file_format == "csv":
        types = _headers(files)
    else:
        types = files.select("path", F.lit("").alias("types"))
    whole = {row.path for row in _with_line_breaks(files, reading).toLocalIterator()} if file_format == "csv" else set()
    groups: dict[tuple[str, bool], list[str]] = {}
    for row in types.toLocalIterator():  # at most the files of one batch
        groups.setdefault((row.types, row.path in whole), []).append(row.path)
    return [(paths, over_lines) for (_, over_lines), paths in groups.items()]


def _read_as_written(spark: SparkSession, paths: Sequence[str], reading: Reading, over_lines: bool) -> DataFrame:
    """Files of one group; of text formats every plain value as text.

    A CSV record with more or fewer fields than the header comes whole in the column ``RECORD`` as well.
    """
    reader = spark.read.format(reading.format).options(**reading.all_options)
    if reading.format == "json":
        reader = reader.option("primitivesAsString", "true")
    elif reading.format == "csv":
        if over_lines:
            reader = reader.option("multiLine", "true")
        columns = reader.option("inferSchema", "false").load(list(paths)).schema
        # without pruning all fields of a record are counted, whatever is asked for later
        reader = (reader.schema(columns.add(RECORD, "string")).option("columnNameOfCorruptRecord", RECORD)
                  .option("mode", "PERMISSIVE").option("columnPruning", "false"))
    return reader.load(list(paths))


def _inferred(spark: SparkSession, paths: Sequence[str], reading: Reading, over_lines: bool) -> T.StructType:
    """What the columns of a group of files look like, for columns that no earlier file had."""
    options = {**reading.all_options, **({"multiLine": "true"} if over_lines else {})}
    return infer_schema(spark, list(paths), reading.format, options) or T.StructType([])


def _with_new_columns(known: T.StructType, parts: Sequence[T.StructType]) -> T.StructType:
    """``known`` and every column it lacks, typed as in the first part that has it."""
    fields = {f.name.lower(): f for f in known.fields}
    for part in parts:
        for field in part.fields:
            fields.setdefault(field.name.lower(), T.StructField(field.name, field.dataType, True))
    return T.StructType(list(fields.values()))


def conforming_rows(files: DataFrame, known: T.StructType, lineage: Callable[[DataFrame], DataFrame],
                    reading: Reading = Reading()) -> tuple[DataFrame, T.StructType] | None:
    """Rows of the listed files in one schema with a rescue column, and that schema.

    ``lineage`` adds columns whose names start with ``_`` while the rows are still bound to
    their files.
    """
    spark = files.sparkSession
    groups = files_by_types(files, reading)
    if not groups:
        return None
    parts = [_read_as_written(spark, paths, reading, over_lines) for paths, over_lines in groups]
    names = {f.name.lower() for f in known.fields}
    schema = known
    if reading.evolve or not names:
        schema = _with_new_columns(known, [
            part.schema if reading.format == "parquet" else _inferred(spark, paths, reading, over_lines)
            for (paths, over_lines), part in zip(groups, parts) if {c.lower() for c in part.columns if c != RECORD} - names])
    rows = [rescue_types(lineage(part), schema) for part in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows), schema
