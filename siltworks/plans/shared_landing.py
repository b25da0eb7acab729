"""Bronze tables from a landing root that all tables share, one per name of a file or of a folder of part files."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Reading
from ..functions import with_lineage
from ..sinks.tables import describe_table
from ..sources.discovery import stem_of
from ..sources.files import _qualified, root_exists
from ..sources.register import FileRegister
from ..streaming.fanout import finished
from ..streaming.intake import Target, intake_stream


def add_lineage(df: DataFrame, stem: str) -> DataFrame:
    return with_lineage(df, ingested_at="_ingest_ts", source_file="_source_file", tags={"_source_name": stem})


def register_of(spark: SparkSession, root: str, schema: str) -> FileRegister:
    """The register of all files of a root."""
    name = hashlib.sha1(root.rstrip("/").encode()).hexdigest()[:12]
    return FileRegister.beside(spark, f"{schema}.root", f"root-{name}")


def run(spark: SparkSession, root: str, schema: str, checkpoint_base: str, reading: Reading = Reading(),
        every: str | None = None, at_once: int = 8) -> dict[str, Exception | None]:
    """Take in new files of every table found; ``every`` keeps the stream running instead.

    One stream feeds all tables, so that a run lists the root once and enters its files in one
    register; a name that turns up later becomes a table of its own. Each table's error, or None,
    comes back.
    """
    if not root_exists(spark, root):
        return {}
    register, errors = register_of(spark, root, schema), {}
    query = intake_stream(
        spark, root, f"{checkpoint_base}/{schema}/_root", register,
        lambda stem: Target(f"{schema}.{stem}_bronze", lambda rows: add_lineage(rows, stem)), reading, every,
        f"*.{reading.format}", stem_of(F.col("path"), _qualified(spark, root)), at_once, errors)
    query.awaitTermination()
    stems = [r.table_name for r in register.planned().select("table_name").distinct().collect()]
    outcomes = {stem: errors.get(stem) for stem in sorted(stems)}
    for stem in finished(outcomes):
        if spark.catalog.tableExists(f"{schema}.{stem}_bronze"):
            describe_table(spark, f"{schema}.{stem}_bronze",
                           f"Raw append-only bronze of {stem}.", {"quality": "bronze"})
    return outcomes
