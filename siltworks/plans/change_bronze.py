"""Land change files of every table of a source in append-only bronze tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Landing
from ..functions import with_lineage
from ..operators.changes import require_op
from ..operators.summarize import op_breakdown
from ..sources.discovery import tables_by_folder
from ..sources.files import list_files
from ..sources.register import FileRegister
from ..streaming.fanout import drain_all, finished
from ..streaming.intake import Target, intake_stream

logger = logging.getLogger(__name__)

# Sequence of changes whose rows carry none: landed paths are dated, and rows are in commit order.
FILE_ORDER = ["_source_file", "_source_row"]
RENAMES = {"Op": "_op"}


def add_lineage(df: DataFrame, landing: Landing, table: str) -> DataFrame:
    return with_lineage(df, ingested_at="_ingested_at", source_file="_source_file",
                        source_row=FILE_ORDER[1] if landing.row_order else None,
                        tags={"_source_table": landing.layout(table).origin})


def start_table(spark: SparkSession, landing: Landing, table: str,
                every: str | None = None) -> StreamingQuery:
    """Take in one table's change files, ``Op`` renamed to ``_op``, with lineage."""
    layout = landing.layout(table)
    if landing.row_order and landing.reading.format != "parquet":
        raise ValueError("only Parquet files tell a row's position")
    if not spark.catalog.tableExists(layout.bronze):
        landed = list_files(spark, layout.landed)
        if landed is None or landed.isEmpty():
            raise ValueError(f"{layout.landed} holds no {landing.reading.format} file to take a schema from")
    target = Target(layout.bronze, lambda rows: add_lineage(require_op(rows, "Op"), landing, table), RENAMES)
    return intake_stream(spark, layout.landed, layout.state, FileRegister.beside(spark, layout.bronze),
                         lambda _: target, landing.reading, every)


def run(spark: SparkSession, landing: Landing, at_once: int = 8) -> dict[str, Exception | None]:
    """Drain every table found below the landing; each table's error, or None, comes back."""
    tables = tables_by_folder(spark, landing.folder)
    if not tables:
        logger.warning("no tables below %s yet", landing.folder)
    starts = {t: (lambda t=t: start_table(spark, landing, t)) for t in tables}
    return drain_all(starts, at_once)


def summary(spark: SparkSession, landing: Landing,
            outcomes: dict[str, Exception | None]) -> DataFrame:
    """Rows per table and change kind of the tables that finished."""
    return op_breakdown({t: spark.table(landing.layout(t).bronze) for t in finished(outcomes)})
