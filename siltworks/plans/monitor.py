"""Run the checks that a table's layer asks for and keep their results."""

from __future__ import annotations

import datetime as dt
import logging
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..config import CheckSpec
from ..operators import quality as q
from ..sinks.tables import append_table
from ..sources.discovery import tables_by_suffix

logger = logging.getLogger(__name__)

RESULT_SCHEMA = ("table string, layer string, check string, metric double, threshold double, passed boolean, "
                 "run_ts timestamp")
INGEST_COLUMNS = ("_ingest_ts", "_ingested_at")


def bronze_results(df: DataFrame, spec: CheckSpec, now: dt.datetime | None = None,
                   run: Column | None = None) -> DataFrame:
    """Freshness, drift and ad-hoc rules in one scan; volume and repeats in one aggregate each."""
    plain = [q.freshness(spec.ingest_column, spec.freshness_sla, now),
             *q.rule_breaches(spec.checks)]
    if "_rescued_data" in df.columns:
        plain.append(q.rescued_rate())
    if spec.expected_columns:
        new = q.added_columns(df.columns, spec.expected_columns)
        plain.append(q.Measure("added_columns", F.max(F.lit(len(new))), 0))
    parts = [q.measure(df, spec.table, spec.layer, plain, now)]
    if spec.volume_tolerance is not None:
        runs = q.volume_runs(df, F.col(spec.ingest_column) if run is None else run,
                             spec.volume_tolerance, spec.baseline_runs, newest_only=True)
        parts.append(q.measure(runs, spec.table, spec.layer,
                               [q.latest_deviation(spec.volume_tolerance)], now))
    content = df.select(*(spec.primary_keys or [c for c in df.columns if not c.startswith("_")]))
    parts.append(q.measure(q.repeat_counts(content, spec.primary_keys or None), spec.table,
                           spec.layer, [q.duplicate_rate()], now))
    return reduce(DataFrame.unionAll, parts)


def silver_results(df: DataFrame, spec: CheckSpec, now: dt.datetime | None = None) -> DataFrame:
    """Rules, required columns and NULL keys in one scan; duplicate keys in one aggregate."""
    plain = [*q.rule_breaches(spec.checks), *q.null_rates(spec.required)]
    if spec.checks:
        plain.append(q.quarantine_rate(spec.checks))
    if spec.primary_keys:
        plain.append(q.null_keys(spec.primary_keys))
    parts = [q.measure(df, spec.table, spec.layer, plain, now)] if plain else []
    if spec.primary_keys:
        parts.append(q.measure(q.repeat_counts(df, spec.primary_keys), spec.table, spec.layer,
                               [q.duplicate_keys(spec.primary_keys)], now))
    if not parts:
        raise ValueError(f"{spec.table} names no keys, required columns or checks")
    return reduce(DataFrame.unionAll, parts)


def discovered_specs(spark: SparkSession, schema: str, declared: Iterable[CheckSpec] = (),
                     suffix: str = "_bronze", ingest_columns: Sequence[str] = INGEST_COLUMNS,
                     **defaults) -> list[CheckSpec]:
    """The declared checks, and bronze checks with ``defaults`` of every other table so named.

    A table's ingest column is the first of ``ingest_columns`` that it has.
    """
    specs = list(declared)
    known = {s.table for s in specs}
    for table in (f"{schema}.{name}" for name in tables_by_suffix(spark, schema, suffix)):
        if table in known:
            continue
        columns = spark.table(table).columns
        ingest = next((c for c in ingest_columns if c in columns), ingest_columns[0])
        specs.append(CheckSpec(table, "bronze", **{"ingest_column": ingest, **defaults}))
    return specs


def results(df: DataFrame, spec: CheckSpec, now: dt.datetime | None = None,
            run: Column | None = None) -> DataFrame:
    if spec.layer == "bronze":
        return bronze_results(df, spec, now, run)
    return silver_results(df, spec, now)


def checked(spark: SparkSession, spec: CheckSpec, moment: dt.datetime) -> list[Row]:
    """The result rows of one table: a few numbers. If its checks can't run, that is a failed result."""
    try:
        return results(spark.table(spec.table), spec, moment).collect()
    except Exception as error:  # a bad table must not keep the others from being checked
        logger.exception("checks of %s failed", spec.table)
        name = f"checks_ran:{type(error).__name__}"
        return [Row(spec.table, spec.layer, name, None, None, False, moment)]


def run(spark: SparkSession, specs: Iterable[CheckSpec], history: str, now: dt.datetime | None = None,
        at_once: int = 8) -> DataFrame:
    """Check every table, each on its own, append all results to ``history`` and return the breaches.

    The history is partitioned by day, and the breaches come from this run's results, so that
    a run reads nothing of the history.
    """
    moment = now or dt.datetime.now(dt.timezone.utc)
    specs = list(specs)
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(specs)))) as pool:
        rows = [tuple(row) for part in pool.map(lambda s: checked(spark, s, moment), specs) for row in part]
    found = spark.createDataFrame(rows, RESULT_SCHEMA)
    append_table(found.withColumn("run_date", F.to_date("run_ts")), history, ["run_date"])
    return q.breaches(found)
