"""Columns that say when and from where a row was ingested."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_lineage(df: DataFrame, ingested_at: str | None = None, ingestion_date: str | None = None,
                 source_file: str | None = None, source_row: str | None = None,
                 tags: dict[str, str] | None = None, now: dt.datetime | None = None) -> DataFrame:
    """Add the named lineage columns in one projection; works on batch and stream alike.

    ``source_file`` and ``source_row`` (position in the file, Parquet only) read the hidden
    file metadata and so need a file-backed ``df``. ``now`` replaces the clock in tests.
    """
    clock = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    added = {}
    if ingested_at:
        added[ingested_at] = clock
    if ingestion_date:
        added[ingestion_date] = F.to_date(clock)
    if source_file:
        added[source_file] = F.col("_metadata.file_path")
    if source_row:
        added[source_row] = F.col("_metadata.row_index")
    for name, text in (tags or {}).items():
        added[name] = F.lit(text)
    return df.withColumns(added) if added else df
