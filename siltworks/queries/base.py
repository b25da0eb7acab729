"""Helpers of the registered queries."""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Callable, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.tables import ensure_schema

NOW = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh_schema(spark: SparkSession) -> str:
    """A new table schema below the shared scratch folder."""
    name = f"silt_{uuid.uuid4().hex[:12]}"
    ensure_schema(spark, name, scratch_path(spark, name))
    return name


def plain(name: str) -> Column:
    """A timestamp column without zone, as the given tables have it."""
    return F.col(name).cast("timestamp_ntz").alias(name)


def nullable(name: str) -> Column:
    """A whole-number column that may be NULL, as double: engines hand such integers to Python in
    different types."""
    return F.col(name).cast("double").alias(name)


def rounded(expression: str, digits: int) -> str:
    """SQL of :func:`siltworks.functions.steady_round`: a decimal has no last bits to differ in."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28, 10)), {digits}) AS DOUBLE)"


def text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)
