"""Batch reads of landed files, format by extension, and wildcard selection."""

from __future__ import annotations

import datetime as dt
import logging
import re
from typing import Iterable, Mapping, Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File extension to Spark format; any other extension is binaryFile.
FORMATS = {
    "json": "json", "csv": "csv", "parquet": "parquet", "pqt": "parquet", "avro": "avro",
    "txt": "text", "text": "text", "orc": "orc", "xml": "xml",
}
COMPRESSION = ("gz", "bz2", "zst", "zstd", "lz4", "snappy", "deflate")
_WILDCARD = frozenset("*?[]")

logger = logging.getLogger(__name__)


def format_of(file_name: str) -> str:
    """Spark format of a file name; a compression suffix is looked through (``x.csv.gz``)."""
    parts = file_name.lower().rsplit("/", 1)[-1].split(".")[1:]
    while parts and parts[-1] in COMPRESSION:
        parts.pop()
    return FORMATS.get(parts[-1], "binaryFile") if parts else "binaryFile"


def arrow_location(uri: str) -> tuple:
    """Arrow file system and path of a Hadoop-style location, for use inside tasks."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else uri).lstrip("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")


def path_missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "") == "PATH_NOT_FOUND"


def list_files(spark: SparkSession, root: str, name_glob: str | None = None) -> DataFrame | None:
    """``path, file_path, modificationTime, length`` of all files below ``root``; None if it is absent.

    ``file_path`` is spelled as the lineage column spells it. The content column is not
    selected, so Spark lists but never opens the files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    try:
        return reader.load(root).select("path", F.col("_metadata.file_path").alias("file_path"),
                                        "modificationTime", "length")
    except AnalysisException as error:
        if path_missing(error):
            return None
        raise


def root_exists(spark: SparkSession, root: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _qualified(spark: SparkSession, root: str) -> str:
    """``root`` as a listing spells it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def find_files(spark: SparkSession, root: str, pattern: str) -> DataFrame | None:
    """Listing of the files below ``root`` that a name or wildcard selects, at any depth.

    A wildcard selects all matches. An exact name selects one file: the first in path order,
    so the choice does not depend on the order of a listing; others of that name are logged.
    A pattern may start with folders (``daily/*.parquet``), which are looked for below ``root``.
    """
    folder, _, name = pattern.rpartition("/")
    found = list_files(spark, root, name)
    if found is None:
        return None
    if folder:
        below = F.substring("path", len(_qualified(spark, root).rstrip("/")) + 2, 1 << 20)
        found = found.where(below.rlike(f"^(?:.*/)?{_glob_regex(folder.strip('/'))}/[^/]+$"))
    if not _WILDCARD.isdisjoint(pattern):
        return found
    first = found.orderBy("path").limit(2).collect()
    if len(first) > 1:
        logger.warning("%s is also at %s; %s is read", pattern, first[1].path, first[0].path)
    return found.where(F.col("path") == first[0].path) if first else found


def matching_files(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Sorted paths that :func:`find_files` selects; [] when nothing matches."""
    found = find_files(spark, root, pattern)
    return [] if found is None else sorted(row.path for row in found.select("path").toLocalIterator())


def _glob_regex(glob: str) -> str:
    """A glob of folder names as a regular expression: ``*``, ``?`` and ``[...]`` stay in a name."""
    out, at = [], 0
    while at < len(glob):
        end = glob.find("]", at + 2) if glob[at] == "[" else -1
        if end > 0:
            inner = glob[at + 1:end].replace("\\", "\\\\").replace("[", "\\[")
            out.append(f"[{'^' + inner[1:] if inner[0] in '!^' else inner}]")
            at = end
        else:
            out.append({"*": "[^/]*", "?": "[^/]"}.get(glob[at], re.escape(glob[at])))
        at += 1
    return "".join(out)


def read_files(spark: SparkSession, paths: str | Sequence[str], file_format: str,
               schema: T.StructType | None = None, options: Mapping[str, str] | None = None,
               ) -> DataFrame:
    """Read with a header and inferred types unless ``schema`` is given (saves a pass over text)."""
    if file_format == "xml" and "rowTag" not in (options or {}):
        raise ValueError("xml files need the rowTag option")
    reader = spark.read.format(file_format)
    if file_format in ("csv", "json", "xml"):
        reader = reader.option("header", "true").option("inferSchema", str(schema is None).lower())
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.options(**(options or {})).load(paths)
    except AnalysisException as error:
        if file_format == "avro" and "avro" in str(error).lower():
            raise ValueError("reading avro needs the spark-avro package on the class path") from error
        raise


def read_matching(spark: SparkSession, root: str, pattern: str,
                  schema: T.StructType | None = None,
                  options: Mapping[str, str] | None = None,
                  seen: DataFrame | None = None) -> DataFrame | None:
    """Read what ``pattern`` selects below ``root``; None when nothing matches.

    ``seen`` holds file paths (one column) to leave out; those files are not opened. Otherwise
    a wildcard on the file name alone goes to Spark as ``pathGlobFilter``.
    """
    file_format = format_of(pattern)
    found = find_files(spark, root, pattern)
    if found is not None and seen is not None:
        known = seen.select(F.col(seen.columns[0]).alias("file_path")).distinct()
        found = found.join(known, "file_path", "left_anti")
    if found is None or found.isEmpty():
        return None
    if seen is None and "/" not in pattern and not _WILDCARD.isdisjoint(pattern):
        lookup = {"recursiveFileLookup": "true", "pathGlobFilter": pattern}
        return read_files(spark, root, file_format, schema, {**lookup, **(options or {})})
    paths = sorted(row.path for row in found.select("path").toLocalIterator())
    return read_files(spark, paths, file_format, schema, options)


def partition_glob(root: str, **choices: Iterable) -> str:
    """``root/locationid={1,2}/year={2023,2024}`` from lists of partition values."""
    levels = ["{}={{{}}}".format(k, ",".join(map(str, v))) for k, v in choices.items()]
    return "/".join([root.rstrip("/"), *levels])


def years_since(start_year: int, today: dt.date | None = None) -> range:
    return range(start_year, (today or dt.date.today()).year + 1)


def read_partitions(spark: SparkSession, root: str, file_format: str,
                    schema: T.StructType | None = None,
                    options: Mapping[str, str] | None = None, **choices: Iterable) -> DataFrame:
    """Read a partitioned tree and keep the chosen partition values.

    The filter is on partition columns, so Spark prunes folders and opens only the chosen ones.
    """
    df = read_files(spark, root, file_format, schema, options)
    for column, values in choices.items():
        df = df.where(F.col(column).isin(list(values)))
    return df


def configured_table(spark: SparkSession, prefix: str, catalog: str = "spark_catalog",
                     schema: str = "default", table: str = "") -> str:
    """``catalog.schema.table`` from the session settings ``<prefix>_catalog`` and so on."""
    defaults = {"catalog": catalog, "schema": schema, "table": table}
    return ".".join(spark.conf.get(f"{prefix}_{part}", value) for part, value in defaults.items())


def read_configured(spark: SparkSession, prefix: str, **defaults: str) -> DataFrame:
    return spark.read.table(configured_table(spark, prefix, **defaults))
