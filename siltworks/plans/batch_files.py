"""Load the files of a domain into its tables, as a config lists them."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..config import DomainConfig, FileEntry
from ..functions import with_lineage
from ..sinks.tables import append_table, write_table
from ..sources.files import find_files, format_of, read_files, read_matching
from ..sources.register import FileRegister, without
from ..streaming.intake import held_files

logger = logging.getLogger(__name__)


def register_of(spark: SparkSession, table: str) -> FileRegister:
    """The register of the files that a table was loaded from; a table that has none yet gets one of
    the files that its rows name."""
    register = FileRegister.beside(spark, table)
    if not register.exists() and spark.catalog.tableExists(table) and "_source_file" in spark.table(table).columns:
        register.seed(spark.table(table))
    return register


def _settle(spark: SparkSession, register: FileRegister, table: str) -> None:
    """Batches that crashed: one whose rows are in the table is done, the files of others may come again."""
    for batch, name in register.unfinished():
        held = spark.catalog.tableExists(table) and not held_files(
            spark, table, register.planned_since(batch)).join(register.files(batch, name), "file_path", "left_semi").isEmpty()
        if held:
            register.finish(batch, [name])


def load_entry(spark: SparkSession, config: DomainConfig, entry: FileEntry) -> DataFrame | None:
    """The rows of one entry with ingest time and file path; None when no file matches."""
    rows = read_matching(spark, config.source_path, entry.name, options=entry.options)
    return None if rows is None else _with_lineage(rows)


def _with_lineage(rows: DataFrame) -> DataFrame:
    return with_lineage(rows, ingested_at="_ingest_timestamp", source_file="_source_file")


def append_entry(spark: SparkSession, config: DomainConfig, entry: FileEntry, table: str) -> bool:
    """Append the files of one entry, or those not taken in yet with ``skip_seen``; False when there are none.

    The files are entered in the register beside the table before they are read, and just these are
    read, whatever lands meanwhile. The table is asked only about batches that crashed.
    """
    register = register_of(spark, table)
    _settle(spark, register, table)
    files = find_files(spark, config.source_path, entry.name)
    if files is not None and config.skip_seen:
        files = without(files, register.taken())
    if files is None or files.isEmpty():
        return False
    batch = uuid.uuid4().hex
    register.plan(batch, files)
    paths = sorted(row.path for row in register.files(batch).select("path").toLocalIterator())  # the reader needs their names
    append_table(_with_lineage(read_files(spark, paths, format_of(entry.name), options=entry.options)), table)
    register.finish(batch)
    return True


def run(spark: SparkSession, config: DomainConfig) -> dict[str, str]:
    """Write every entry's table; returns entry name -> table for the entries that had files."""
    written = {}
    for entry in config.files:
        table = f"{config.target_schema}.{entry.table}"
        if config.mode == "append":
            found = append_entry(spark, config, entry, table)
        elif (rows := load_entry(spark, config, entry)) is not None:
            write_table(rows, table, config.mode)
            FileRegister.beside(spark, table).clear()  # it knew the files of the rows that are gone
            found = True
        else:
            found = False
        if found:
            written[entry.name] = table
        else:
            logger.warning("no (new) file matches %s below %s", entry.name, config.source_path)
    return written
