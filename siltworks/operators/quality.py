"""Data-quality checks as rows ``(table, layer, check, metric, threshold, passed, run_ts)``.

Checks that are plain aggregates of one table are computed together in one scan of it; a check
that must group by a key adds one more aggregate. Metrics are "smaller is better": a check
passes while ``metric <= threshold``. A check without threshold informs and always passes.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from functools import reduce
from typing import Mapping, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .changes import overlaps_next, with_next_start
from .rank import rolling_baseline

RESULT_COLUMNS = ["table", "layer", "check", "metric", "threshold", "passed", "run_ts"]

_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


class Measure(NamedTuple):
    """``value`` is an aggregate; ``missing_passes`` says how a NULL metric counts."""

    check: str
    value: Column
    threshold: float | None = None
    missing_passes: bool = True


def sla_seconds(text: str) -> int:
    """``24h``, ``30m``, ``7d`` in seconds."""
    match = re.fullmatch(r"\s*(\d+)\s*([smhdw])\s*", text.lower())
    if not match:
        raise ValueError(f"not a duration such as 24h: {text!r}")
    return int(match[1]) * _UNIT_SECONDS[match[2]]


def _clock(now: dt.datetime | None) -> Column:
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


def _holds(rule: str) -> Column:
    """A rule that evaluates to NULL does not hold."""
    return F.coalesce(F.expr(rule), F.lit(False))


def measure(df: DataFrame, table: str, layer: str, measures: Sequence[Measure],
            now: dt.datetime | None = None) -> DataFrame:
    """Evaluate all measures in one aggregate of ``df`` and turn them into result rows."""
    return _results(df.agg(*_values(measures)), table, layer, measures, now)


def observe(df: DataFrame, measures: Sequence[Measure]) -> tuple[DataFrame, Observation]:
    """``df`` whose measures are taken while it is written, and what will hold them: a batch is checked
    without reading it again. Only the first action on the rows counts."""
    seen = Observation(f"measures-{uuid.uuid4().hex}")
    return df.observe(seen, *_values(measures)), seen


def observed(spark: SparkSession, seen: Observation, table: str, layer: str, measures: Sequence[Measure],
             now: dt.datetime | None = None) -> DataFrame:
    """The same result rows as :func:`measure`, from rows that have been written."""
    found = seen.get
    names = [f"m{i}" for i in range(len(measures))]
    totals = spark.createDataFrame([tuple(found.get(name) for name in names)], ", ".join(f"{name} double" for name in names))
    return _results(totals, table, layer, measures, now)


def _values(measures: Sequence[Measure]) -> list[Column]:
    return [m.value.cast("double").alias(f"m{i}") for i, m in enumerate(measures)]


def _results(totals: DataFrame, table: str, layer: str, measures: Sequence[Measure], now: dt.datetime | None) -> DataFrame:
    """A row per measure from one row of their values."""
    rows = []
    for i, m in enumerate(measures):
        metric = F.col(f"m{i}")
        limit = F.lit(m.threshold).cast("double")
        passed = F.lit(True) if m.threshold is None else \
            F.coalesce(metric <= limit, F.lit(m.missing_passes))
        rows.append(F.struct(F.lit(table).alias("table"), F.lit(layer).alias("layer"),
                             F.lit(m.check).alias("check"), metric.alias("metric"),
                             limit.alias("threshold"), passed.alias("passed"),
                             _clock(now).alias("run_ts")))
    return totals.select(F.inline(F.array(*rows)))


# --- measures that share one scan -------------------------------------------------------

def freshness(ingest_column: str, sla: str | None, now: dt.datetime | None = None) -> Measure:
    """Seconds since the newest ingest; a table without rows is not fresh."""
    newest = F.max(F.col(ingest_column).cast("timestamp"))
    age = F.unix_micros(_clock(now)) - F.unix_micros(newest)
    return Measure("freshness_seconds", age / 1_000_000,
                   None if sla is None else sla_seconds(sla), missing_passes=False)


def rescued_rate(column: str = "_rescued_data", limit: float | None = 0.0) -> Measure:
    return Measure("rescued_rate", F.avg(F.col(column).isNotNull().cast("double")), limit)


def null_rates(columns: Sequence[str], limit: float = 0.0) -> list[Measure]:
    return [Measure(f"null_rate:{c}", F.avg(F.col(c).isNull().cast("double")), limit)
            for c in columns]


def rule_breaches(rules: Mapping[str, str]) -> list[Measure]:
    """Rows on which each named SQL condition does not hold."""
    return [Measure(f"rule:{name}", F.count_if(~_holds(rule)), 0) for name, rule in rules.items()]


def null_keys(keys: Sequence[str]) -> Measure:
    return Measure("null_keys", F.count_if(reduce(lambda a, b: a | b,
                                                  [F.col(k).isNull() for k in keys])), 0)


def added_columns(actual: Sequence[str], expected: Sequence[str]) -> list[str]:
    """Columns of a table that its expected list lacks; names starting with ``_`` are ours."""
    return sorted(c for c in actual if c not in set(expected) and not c.startswith("_"))


# --- measures with a grouping of their own ----------------------------------------------

def repeat_counts(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows per key, or per whole row. Combined on the map side, so a hot key is one row per
    task in the shuffle. Whole rows are compared by 128 hash bits instead of being shuffled; a
    hash passes over NULLs, so a row's NULLs are flagged in numbers that are hashed with it."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    flags = [reduce(lambda a, b: a + b, [F.when(c.isNull(), F.lit(1 << k).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
                                         for k, c in enumerate(columns[start:start + 60])]) for start in range(0, len(columns), 60)]
    by = [F.col(k) for k in keys] if keys else [
        F.xxhash64(*flags, *columns).alias("_row_hash"),
        F.xxhash64(F.lit("again"), *flags, *columns).alias("_row_hash_again")]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("_copies"))


def duplicate_rate(limit: float | None = None) -> Measure:
    """Share of rows beyond the first of their key, over :func:`repeat_counts`."""
    return Measure("duplicate_rate", 1 - F.count(F.lit(1)) / F.sum("_copies"), limit)


def duplicate_keys(keys: Sequence[str]) -> Measure:
    """Keys held by more than one row, over :func:`repeat_counts`; NULL keys are counted apart."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return Measure("duplicate_keys", F.count_if((F.col("_copies") > 1) & complete), 0)


def volume_runs(df: DataFrame, run: Column | str, tolerance: float, baseline_runs: int,
                file_column: str | None = None, newest_only: bool = False) -> DataFrame:
    """Rows (and files) of each run against the average of the runs before it.

    With ``newest_only`` the newest run alone comes back, and only the runs of its baseline reach
    the window, however many there ever were.
    """
    run_column = (F.col(run) if isinstance(run, str) else run).alias("run")
    if file_column:
        per_file = df.groupBy(run_column, F.col(file_column).alias("_file")).agg(
            F.count(F.lit(1)).alias("_rows"))
        runs = per_file.groupBy("run").agg(F.sum("_rows").alias("row_count"),
                                           F.count("_file").alias("file_count"))
    else:
        runs = df.groupBy(run_column).agg(F.count(F.lit(1)).alias("row_count"))
    if newest_only:
        runs = runs.orderBy(F.col("run").desc_nulls_last()).limit(baseline_runs + 1)
    timed = rolling_baseline(runs, [], "run", "row_count", baseline_runs, "baseline")
    if newest_only:
        timed = timed.orderBy(F.col("run").desc_nulls_last()).limit(1)
    deviation = F.when(F.col("baseline") > 0,
                       F.abs(F.col("row_count") - F.col("baseline")) / F.col("baseline"))
    return timed.withColumn("deviation", deviation).withColumn(
        "breached", F.coalesce(F.col("deviation") > tolerance, F.lit(False)))


def latest_deviation(tolerance: float | None) -> Measure:
    """Deviation of the newest run, over :func:`volume_runs`."""
    return Measure("volume_deviation", F.max_by("deviation", "run"), tolerance)


def missing_files(landed: DataFrame, ingested: DataFrame, path: str = "file_path",
                  file_column: str = "_source_file") -> DataFrame:
    """Landed files that no ingested row names; ``landed`` comes from ``list_files``."""
    seen = ingested.select(F.col(file_column).alias(path)).distinct()
    return landed.select(path).join(seen, path, "left_anti")


def with_failed_rules(df: DataFrame, rules: Mapping[str, str], name: str = "_failed") -> DataFrame:
    """Add the names of the rules each row fails, in one pass."""
    verdicts = F.array(*[F.when(~_holds(rule), F.lit(label)) for label, rule in rules.items()])
    return df.withColumn(name, F.array_compact(verdicts))


def quarantine(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows that hold every rule, and the others with the rules they fail.

    The kept side filters on the rules as they are, so that they can reach the scan.
    """
    kept = df
    for rule in rules.values():
        kept = kept.where(rule)
    return kept, with_failed_rules(df.where(~_holds_all(rules)), rules)


def _holds_all(rules: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [_holds(rule) for rule in rules.values()])


def quarantine_rate(rules: Mapping[str, str], limit: float | None = None) -> Measure:
    return Measure("quarantine_rate", F.avg((~_holds_all(rules)).cast("double")), limit)


def version_faults(history: DataFrame, keys: Sequence[str], valid_from: str = "valid_from",
                   valid_to: str = "valid_to", is_current: str = "is_current") -> DataFrame:
    """One row: keys with more than one current row, and versions that overlap the next.

    The history is read once, and of it the columns that are needed.
    """
    needed = history.select(*dict.fromkeys([*keys, valid_from, valid_to, is_current]))
    timed = with_next_start(needed, keys, valid_from, valid_to)
    per_key = timed.groupBy(*keys).agg(F.count_if(F.col(is_current)).alias("_current"),
                                       F.count_if(overlaps_next(valid_to)).alias("_overlaps"))
    return per_key.agg(F.count_if(F.col("_current") > 1).alias("keys_with_several_current"),
                       F.coalesce(F.sum("_overlaps"), F.lit(0)).alias("overlapping_versions"))


def reconcile(bronze: DataFrame, kept: DataFrame, quarantined: DataFrame,
              deduplicated: int | Column = 0) -> DataFrame:
    """One row: do the kept, quarantined and de-duplicated rows add up to bronze?"""
    parts = {"bronze_rows": bronze, "kept_rows": kept, "quarantined_rows": quarantined}
    tagged = reduce(DataFrame.unionAll, [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        for name, df in parts.items()])
    sums = tagged.agg(*[F.sum(F.when(F.col("part") == name, F.col("n"))).alias(name)
                        for name in parts])
    repeats = F.lit(deduplicated) if isinstance(deduplicated, int) else deduplicated
    lost = (F.col("bronze_rows") - F.col("kept_rows") - F.col("quarantined_rows")
            - repeats.cast("bigint"))
    return sums.withColumns({"deduplicated_rows": repeats.cast("bigint"), "unexplained_rows": lost})


def reconcile_rules(bronze: DataFrame, rules: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """:func:`reconcile` where all parts come from one table: rows that fail a rule are quarantined,
    and of the others one per key is kept. One scan and one aggregate by key."""
    per_key = bronze.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.count_if(_holds_all(rules)).alias("_passed"))
    sums = per_key.agg(F.sum("_rows").alias("bronze_rows"), F.count_if(F.col("_passed") > 0).alias("kept_rows"),
                       F.sum(F.col("_rows") - F.col("_passed")).alias("quarantined_rows"),
                       F.sum(F.greatest(F.col("_passed") - 1, F.lit(0))).alias("deduplicated_rows"))
    counts = sums.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in sums.columns])
    return counts.withColumn("unexplained_rows", F.col("bronze_rows") - F.col("kept_rows") - F.col("quarantined_rows")
                             - F.col("deduplicated_rows"))


def lost_keys(bronze: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Keys of bronze that no part holds, NULL keys included: one aggregate over both sides, so that
    a key that fills a table is one row per task in the shuffle."""
    sides = [bronze.select(*keys, F.lit(False).alias("_held")),
             *[p.select(*keys, F.lit(True).alias("_held")) for p in parts]]
    held = reduce(DataFrame.unionAll, sides).groupBy(*keys).agg(
        F.max("_held").alias("_held"), F.max(~F.col("_held")).alias("_in_bronze"))
    return held.where(F.col("_in_bronze") & ~F.col("_held")).select(*keys)


def distribution_shift(baseline: DataFrame, current: DataFrame, bin_of: Column,
                       floor: float = 1e-6) -> DataFrame:
    """Shares per bin of both sides with each bin's stability-index and variation parts."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias(name))

    sides = shares(baseline, "baseline_rows").unionByName(shares(current, "current_rows"),
                                                          allowMissingColumns=True)
    # Staged, because the totals below would otherwise read both tables again.
    bins = stage(sides.groupBy("bin").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                                            for c in ("baseline_rows", "current_rows")]), "bins")
    before, after = [F.col(c) / bins.agg(F.sum(c)).scalar() for c in ("baseline_rows", "current_rows")]
    low, high = F.greatest(before, F.lit(floor)), F.greatest(after, F.lit(floor))
    return bins.select("bin", before.alias("baseline_share"), after.alias("current_share"),
                         ((high - low) * F.log(high / low)).alias("stability_part"),
                         (F.abs(after - before) / 2).alias("variation_part"))


def shift_score(shift: DataFrame) -> DataFrame:
    return shift.agg(F.sum("stability_part").alias("stability_index"),
                     F.sum("variation_part").alias("total_variation"))


# --- history, alerts, summaries ---------------------------------------------------------

def breaches(results: DataFrame) -> DataFrame:
    """Results that should raise an alert; none means all is well."""
    return results.where(~F.col("passed"))


def alert_on_count(df: DataFrame, condition: str, name: str = "records_breached",
                   threshold: float = 0) -> DataFrame:
    """One row when more rows than ``threshold`` meet ``condition``, no row otherwise."""
    counted = df.where(condition).agg(F.count(F.lit(1)).alias(name))
    return counted.where(F.col(name) > threshold)


def latest_results(history: DataFrame) -> DataFrame:
    """Newest result of each check of each table."""
    payload = F.struct("metric", "threshold", "passed", "run_ts")
    newest = history.groupBy("table", "layer", "check").agg(F.max_by(payload, "run_ts").alias("r"))
    return newest.select("table", "layer", "check", "r.*")


def daily_breaches(history: DataFrame) -> DataFrame:
    """Checks run and breached per layer, table and day."""
    return history.groupBy("layer", "table", F.to_date("run_ts").alias("run_date")).agg(
        F.count(F.lit(1)).alias("checks_run"), F.count_if(~F.col("passed")).alias("breaches"))
