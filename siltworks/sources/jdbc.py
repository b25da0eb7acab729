"""Partitioned read of a database table."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

# URL prefix and default port of each supported database.
_PORTS = {"mysql": 3306, "postgresql": 5432, "sqlserver": 1433}


@dataclass(frozen=True)
class Connection:
    """Where a foreign database is; ``options`` reach the driver as they are."""

    type: str
    host: str
    user: str
    password: str = field(repr=False)
    port: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def url(self, database: str) -> str:
        if self.type not in _PORTS:
            raise ValueError(f"unknown database type {self.type!r}; known: {sorted(_PORTS)}")
        address = f"{self.host}:{self.port or _PORTS[self.type]}"
        if self.type == "sqlserver":
            return f"jdbc:sqlserver://{address};databaseName={database}"
        return f"jdbc:{self.type}://{address}/{database}"


def split_options(column: str | None, lower: object, upper: object,
                  partitions: int) -> dict[str, str]:
    """Options that cut the read into ranges of ``column``.

    Bounds only place the cuts: rows outside them, and NULLs, still arrive in the outer ranges.
    """
    if column is None:
        return {}
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions)}


def read_database(spark: SparkSession, connection: Connection, database: str, table: str,
                  split_by: str | None = None, partitions: int = 32,
                  fetch_rows: int = 10_000) -> DataFrame:
    """Read-only table of a foreign database; filters, columns and limits are pushed down.

    With ``split_by`` its smallest and largest value are asked from the database first, which
    an index answers, and the table is read in that many ranges at once.
    """
    base = {"url": connection.url(database), "user": connection.user,
            "password": connection.password, "fetchsize": str(fetch_rows), **connection.options}
    source = spark.read.format("jdbc").options(**base)
    if split_by is None:
        return source.option("dbtable", table).load()
    ends = source.option(
        "query", f"SELECT MIN({split_by}) AS lo, MAX({split_by}) AS hi FROM {table}").load().first()
    cuts = {} if ends.lo is None else split_options(split_by, ends.lo, ends.hi, partitions)
    return spark.read.format("jdbc").options(**base, **cuts).option("dbtable", table).load()
