"""Create, append to, replace and describe tables.

Tables are Parquet unless the session setting ``siltworks.table.format`` names another format.
"""

from __future__ import annotations

import re
import time
import uuid
from contextlib import contextmanager
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TableSpec
from ..operators.rescue import fits
from ..sources.discovery import database_location

_FILE_FORMATS = ("parquet", "orc")


def table_format(spark: SparkSession) -> str:
    return spark.conf.get("siltworks.table.format", "parquet")


def keeps_files(spark: SparkSession) -> bool:
    """Whether a table is a folder of data files, whose times the store knows."""
    return table_format(spark) in _FILE_FORMATS


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    """A session setting for one statement."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None,
                  use: bool = False) -> None:
    place = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{place}")
    if use:
        spark.catalog.setCurrentDatabase(schema)


def create_table(spark: SparkSession, spec: TableSpec) -> None:
    """Create the table a spec declares, with column comments, unless it exists."""
    columns = ", ".join(f"`{c.name}` {c.type}" + (f" COMMENT {_quoted(c.comment)}" if c.comment else "")
                        for c in spec.columns)
    comment = f" COMMENT {_quoted(spec.comment)}" if spec.comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {spec.name} ({columns}) "
              f"USING {table_format(spark)}{comment}")
    if spec.properties:
        describe_table(spark, spec.name, properties=spec.properties)


def describe_table(spark: SparkSession, table: str, comment: str | None = None,
                   properties: Mapping[str, str] | None = None) -> None:
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def add_columns(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Add the columns of ``schema`` the table lacks; returns their names."""
    have = {c.lower() for c in spark.table(table).columns}
    new = [f for f in schema.fields if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ("
                  + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
        spark.catalog.refreshTable(table)
    return [f.name for f in new]


def _laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather each table partition's rows in few files.

    A rebalance, unlike a plain repartition, lets adaptive execution split a partition value
    that holds most rows and merge small ones.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def _kept_whole(table: str, name: str, source: T.DataType, target: T.DataType) -> Column:
    """The column as ``target``; a value that the cast would change stops the job."""
    column = F.col(f"`{name}`")
    if source == target:
        return column
    message = F.concat(F.lit(f"column {name} of {table} is {target.simpleString()} and can't hold "),
                       column.cast("string"))
    return F.when(fits(column, source, target), column.try_cast(target)).otherwise(F.raise_error(message))


def append_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Append; columns new to the table widen it first, columns it alone has become NULL.

    Values are cast to the table's types where they keep all of themselves; one that does not is
    an error that names table and column.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return replace_table(df, table, partition_by)
    add_columns(spark, table, df.schema)
    _laid_out(_aligned(df, table), partition_by).write.mode("append").insertInto(table)


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """The columns of ``df`` as the table has them."""
    have = {f.name.lower(): f for f in df.schema.fields}
    aligned = []
    for field in df.sparkSession.table(table).schema.fields:
        own = have.get(field.name.lower())
        value = F.lit(None).cast(field.dataType) if own is None else _kept_whole(table, own.name, own.dataType, field.dataType)
        aligned.append(value.alias(field.name))
    return df.select(*aligned)


def replace_partitions(df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of, and no others. ``df`` must not read them itself.

    Doing it again with the same rows changes nothing, so a run that breaks off can be repeated.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return replace_table(df, table, partition_by)
    add_columns(spark, table, df.schema)
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        _laid_out(_aligned(df, table), partition_by).write.mode("overwrite").insertInto(table)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Replace rows and schema of a table, partitioned if asked.

    The new rows are written whole to a folder of their own, a version of the table, and then the
    table is pointed at it, so that a failing write leaves the table as it was. A table whose columns
    all stay is pointed there in one step: no reader ever misses it, and comments and properties stay as
    they are. Only where columns go or change their type is the catalog entry made anew, under another
    name first, with the old comment and properties. Old versions stay until :func:`vacuum`. Table
    formats that replace atomically do it themselves.
    """
    spark, kind = df.sparkSession, table_format(df.sparkSession)
    writer = _laid_out(df, partition_by).write.format(kind)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind not in _FILE_FORMATS:
        writer.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)
        return
    *parent, name = table.split(".")
    location = f"{database_location(spark, '.'.join(parent))}/{name}-{uuid.uuid4().hex}"
    writer.save(location)
    if not spark.catalog.tableExists(table):
        _create_at(spark, table, df.schema, partition_by, kind, location)
    elif _points_on(spark, table, df.schema, partition_by):
        add_columns(spark, table, df.schema)
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(location)}")
        spark.catalog.refreshTable(table)
    else:
        comment, properties = described(spark, table)
        fresh = ".".join([*parent, f"{name}_{uuid.uuid4().hex}"])
        _create_at(spark, fresh, df.schema, partition_by, kind, location, comment, properties)
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")


def _create_at(spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str], kind: str, location: str,
               comment: str | None = None, properties: Mapping[str, str] | None = None) -> None:
    order = [f for f in schema.fields if f.name not in partition_by] + [schema[c] for c in partition_by]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in order)
    layout = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    # partitions are those of the folder, so that it can be exchanged in one step
    with _setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {kind}{layout} LOCATION {_quoted(location)}")
    describe_table(spark, table, comment, properties)


def described(spark: SparkSession, table: str) -> tuple[str | None, dict[str, str]]:
    """Comment and properties of a table."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    own = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return rows.get("Comment"), {k: v for k, v in own.items() if k != "transient_lastDdlTime" and not k.startswith("option.")}


def _points_on(spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str]) -> bool:
    """Whether the table only needs a new location, and perhaps further columns: its columns stay, and
    it knows its partitions from its folder."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    facts = {r.col_name: r.data_type for r in rows}
    have = {f.name.lower(): f.dataType for f in schema.fields}
    kept = spark.table(table).schema.fields
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return (facts.get("Provider") in _FILE_FORMATS and facts.get("Partition Provider") is None
            and partitions == list(partition_by) and all(have.get(f.name.lower()) == f.dataType for f in kept)
            and not (partition_by and len(have) > len(kept)))


def table_location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first().data_type


def old_versions(spark: SparkSession, table: str) -> list[tuple[str, int]]:
    """Folders of versions that the table points to no more (or never did, when a run broke off), and
    when each was written, in milliseconds."""
    *parent, name = table.split(".")
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(database_location(spark, ".".join(parent)))
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    current = jvm.org.apache.hadoop.fs.Path(table_location(spark, table)).getName()
    folders = [s for s in files.listStatus(base) if s.isDirectory()] if files.exists(base) else []
    return sorted((s.getPath().toString(), s.getModificationTime()) for s in folders
                  if re.fullmatch(re.escape(name) + "(-[0-9a-f]{32})?", s.getPath().getName()) and s.getPath().getName() != current)


def vacuum(spark: SparkSession, table: str, older_than_hours: float = 168) -> list[str]:
    """Delete old versions last written so long ago; readers and writers that take longer would fail."""
    jvm = spark.sparkContext._jvm
    limit = time.time() * 1000 - older_than_hours * 3_600_000
    gone = [path for path, written in old_versions(spark, table) if written <= limit]
    for path in gone:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return gone


def write_table(df: DataFrame, table: str, mode: str = "append",
                partition_by: Sequence[str] = ()) -> None:
    writers = {"append": append_table, "overwrite": replace_table}
    if mode not in writers:
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    writers[mode](df, table, partition_by)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first ``rows`` rows, unordered."""
    return df.limit(rows)
