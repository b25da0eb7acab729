"""Named datasets as plain functions, written in the order they are declared."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sinks.tables import describe_table, replace_table
from ..streaming.landing import append_stream


@dataclass(frozen=True)
class Dataset:
    build: Callable[[SparkSession], DataFrame]
    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)


class DatasetMap(dict):
    """Table name -> :class:`Dataset`."""

    def table(self, name: str | None = None, comment: str = "",
              properties: Mapping[str, str] | None = None):
        """Decorator that declares ``function(spark)`` as a table."""
        def declare(build: Callable[[SparkSession], DataFrame]):
            self[name or build.__name__] = Dataset(build, comment, properties or {})
            return build
        return declare

    def write_all(self, spark: SparkSession, schema: str, checkpoint_base: str) -> list[str]:
        """Replace batch tables and append what is new to streamed ones."""
        for name, dataset in self.items():
            df, table = dataset.build(spark), f"{schema}.{name}"
            if df.isStreaming:
                append_stream(df, table, f"{checkpoint_base}/{schema}/{name}").awaitTermination()
            else:
                replace_table(df, table)
            describe_table(spark, table, dataset.comment or None, dataset.properties)
        return list(self)
