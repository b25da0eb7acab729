"""Which tables are there? By folder, by file name, or by catalog suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import _qualified, list_files, root_exists


def tables_by_folder(spark: SparkSession, root: str) -> list[str]:
    """Sorted names of the folders directly below ``root``; [] when it does not exist yet."""
    if not root_exists(spark, root):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def tables_by_stem(spark: SparkSession, root: str, file_format: str) -> list[str]:
    """Sorted distinct names of the files or folders that are tables, without extension; one name in
    many folders is one table."""
    listing = list_files(spark, root, f"*.{file_format}")
    if listing is None:
        return []
    return stems_of(listing, _qualified(spark, root))


def stem_of(path: Column, root: str) -> Column:
    """The name, without extension, of the table that a file below ``root`` belongs to.

    It is that of the file itself, or of the first folder below ``root`` that has the file's extension:
    Spark writes a table as such a folder of part files (``orders.parquet/part-00000.parquet``). ``root``
    is spelled as listings spell it; folders above it don't count.
    """
    base = root.rstrip("/") + "/"
    file_name = F.regexp_extract(path, r"[^/]+$", 0)
    below = F.when(path.startswith(F.lit(base)), F.substring(path, len(base) + 1, 1 << 20)).otherwise(file_name)
    folder = F.regexp_extract(below, r"^(?:[^/]+/)*?([^/]+)(\.[^./]+)/(?:[^/]+/)*[^/]+\2$", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(file_name, r"([^/]+)\.[^./]+$", 1))


def stems_of(listing: DataFrame, root: str) -> list[str]:
    """Sorted distinct table names of a listing of the files below ``root``, see :func:`stem_of`."""
    stems = listing.select(stem_of(F.col("path"), root).alias("stem")).where("stem <> ''").distinct()
    # One row per table, not per file.
    return sorted(row.stem for row in stems.toLocalIterator())


def database_location(spark: SparkSession, database: str = "") -> str:
    """Where a database keeps its tables."""
    return spark.sql(f"DESCRIBE SCHEMA {database or spark.catalog.currentDatabase()}").where(
        "info_name = 'Location'").first().info_value.rstrip("/")


def tables_by_suffix(spark: SparkSession, schema: str, suffix: str = "_bronze") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema) if t.name.endswith(suffix))
