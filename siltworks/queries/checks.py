"""Data-quality checks over whole tables; the clock stands at a fixed moment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CheckSpec
from ..functions import steady_round
from ..operators import quality as q
from ..operators.clean import drop_repeats
from ..operators.locate import locate_differences
from ..plans import monitor
from ..sinks.tables import append_table
from .base import NOW, Query, fresh_schema, read, rounded

ORDER_RULES = {"price_in_range": "o_totalprice BETWEEN 1000 AND 400000",
               "status_known": "o_orderstatus IN ('F', 'O')",
               "urgent_is_dear": "o_orderpriority <> '1-URGENT' OR o_totalprice > 50000"}


def _rows(results: DataFrame) -> DataFrame:
    """Result rows without the clock, metrics rounded."""
    return results.drop("run_ts").withColumns(
        {"metric": steady_round("metric", 6), "threshold": steady_round("threshold", 6)})


def _daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").withColumn("run_day", F.to_date("ts").cast("string"))


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = [q.freshness("ts", "24h", NOW)._replace(check="within_day"),
                q.freshness("ts", "7d", NOW)._replace(check="within_week")]
    return _rows(q.measure(read(spark, sf_dir, "events"), "events", "bronze", measures, NOW))


def dq_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day against the average of the seven days before."""
    runs = q.volume_runs(_daily_runs(spark, sf_dir), "run_day", 0.02, 7, file_column="event_type")
    return runs.withColumns({"baseline": steady_round("baseline", 6), "deviation": steady_round("deviation", 6)})


def dq_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").withColumn(
        "_rescued_data", F.when(F.col("p_brand") == "Brand#7", '{"p_size":"x"}'))
    new = q.added_columns(parts.columns, ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    return _rows(q.measure(parts, "part", "bronze", [
        q.rescued_rate(), q.Measure("added_columns", F.max(F.lit(len(new))), 0)], NOW))


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats by key, by whole row, and by a key whose few values fill the table."""
    lines = read(spark, sf_dir, "lineitem")
    by_key = q.measure(q.repeat_counts(lines, ["l_orderkey", "l_linenumber"]), "lineitem by key",
                       "bronze", [q.duplicate_rate()], NOW)
    by_row = q.measure(q.repeat_counts(lines), "lineitem by row", "bronze", [q.duplicate_rate()], NOW)
    by_flag = q.measure(q.repeat_counts(lines, ["l_returnflag"]), "lineitem by flag", "bronze",
                        [q.duplicate_rate(0.5)], NOW)
    moved = read(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.array(
        F.struct(F.lit(None).cast("string").alias("first"), F.col("o_orderstatus").alias("second")),
        F.struct(F.col("o_orderstatus").alias("first"), F.lit(None).cast("string").alias("second")))).alias("s"))
    by_place = q.measure(q.repeat_counts(moved.select("o_orderkey", "s.first", "s.second")), "orders by moved status",
                         "bronze", [q.duplicate_rate()], NOW)
    return _rows(by_key.unionAll(by_row).unionAll(by_flag).unionAll(by_place))


def dq_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items against a copy with changed, lost, repeated and foreign rows: the orders concerned."""
    lines = read(spark, sf_dir, "lineitem")
    order = F.col("l_orderkey")
    copy = lines.where(~((order % 1009 == 7) & (F.col("l_linenumber") == 1))).withColumn(
        "l_quantity", F.when(order % 997 == 5, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    repeated = lines.where(order % 1501 == 11)
    foreign = lines.where(order % 2003 == 1).withColumn("l_orderkey", order + 100_000_000)
    found = locate_differences(lines, copy.unionByName(repeated).unionByName(foreign), "l_orderkey")
    return found.select("l_orderkey", "left_rows", "right_rows")


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that fail a rule, with the rules they fail."""
    _, quarantined = q.quarantine(read(spark, sf_dir, "orders"), ORDER_RULES)
    return quarantined.select("o_orderkey", F.array_join("_failed", ",").alias("failed"))


def dq_quarantine_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(q.measure(read(spark, sf_dir, "orders"), "orders", "silver",
                           [q.quarantine_rate(ORDER_RULES, 0.5)], NOW))


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return orders.withColumns({
        "o_orderpriority": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
        "o_custkey": F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))})


def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(q.measure(_gaps(spark, sf_dir), "orders", "silver",
                           q.null_rates(["o_orderkey", "o_custkey", "o_orderpriority"], 0.25), NOW))


def dq_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over columns with NULLs: a NULL verdict does not hold."""
    rules = {"key_not_negative": "o_custkey >= 0", "priority_known": "o_orderpriority LIKE '_-%'"}
    return _rows(q.measure(_gaps(spark, sf_dir), "orders", "silver", q.rule_breaches(rules), NOW))


def dq_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of ``dq_rules`` and ``dq_nulls``, taken while the rows are written to a table."""
    rules = {"key_not_negative": "o_custkey >= 0", "priority_known": "o_orderpriority LIKE '_-%'"}
    measures = [*q.rule_breaches(rules), *q.null_rates(["o_orderkey", "o_custkey", "o_orderpriority"], 0.25)]
    rows, seen = q.observe(_gaps(spark, sf_dir), measures)
    append_table(rows, f"{fresh_schema(spark)}.orders_silver")
    return _rows(q.observed(spark, seen, "orders", "silver", measures, NOW))


def dq_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for table, df, keys in [("orders", _gaps(spark, sf_dir), ["o_custkey"]),
                            ("lineitem", read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])]:
        rows.append(q.measure(df, table, "silver", [q.null_keys(keys)], NOW))
        rows.append(q.measure(q.repeat_counts(df, keys), table, "silver", [q.duplicate_keys(keys)], NOW))
    return _rows(rows[0].unionAll(rows[1]).unionAll(rows[2]).unionAll(rows[3]))


def dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines split into kept, quarantined and repeated ones; nothing is unexplained."""
    lines = read(spark, sf_dir, "lineitem")
    rules = {"has_discount": "l_discount > 0"}
    return q.reconcile_rules(lines, rules, ["l_orderkey", "l_linenumber"])


def dq_lost_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders no line item refers to."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return q.lost_keys(read(spark, sf_dir, "orders"), [lines], ["o_orderkey"])


def dq_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices of the years before 1998 against those since, in bins of 50,000."""
    orders = read(spark, sf_dir, "orders")
    early = F.year("o_orderdate") < 1998
    shift = q.distribution_shift(orders.where(early), orders.where(~early),
                                 F.floor(F.col("o_totalprice") / F.lit(50000.0)))
    return shift.select("bin", *[steady_round(c, 6).alias(c) for c in shift.columns[1:]])


def dq_distribution_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types of the first half of the month against the second; one appears only later."""
    events = read(spark, sf_dir, "events")
    first_half = F.dayofmonth("ts") <= 15
    shift = q.distribution_shift(events.where(first_half & (F.col("event_type") != "signup")),
                                 events.where(~first_half), F.col("event_type"))
    return q.shift_score(shift).select(steady_round("stability_index", 4).alias("stability_index"),
                                       steady_round("total_variation", 6).alias("total_variation"))


_SPECS = [
    CheckSpec("events_bronze", "bronze", freshness_sla="24h", volume_tolerance=0.5,
              expected_columns=["event_id", "ts", "user_id", "event_type", "value"],
              primary_keys=["event_id"], ingest_column="ts"),
    CheckSpec("orders_silver", "silver", primary_keys=["o_orderkey"], required=["o_custkey"],
              checks={"price_positive": "o_totalprice > 0", "status_known": "o_orderstatus IN ('F', 'O')"}),
]


def _checked(spark: SparkSession, sf_dir: str, spec: CheckSpec) -> DataFrame:
    source = read(spark, sf_dir, spec.table.split("_")[0])
    return monitor.results(source, spec, NOW, run=F.to_date(spec.ingest_column))


def monitor_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a bronze and of a silver table, chosen by layer."""
    return _rows(_checked(spark, sf_dir, _SPECS[0]).unionAll(_checked(spark, sf_dir, _SPECS[1])))


def monitor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of monitored tables kept in a history table, summed up per table and day."""
    schema = fresh_schema(spark)
    specs = []
    for spec in _SPECS[1:]:
        read(spark, sf_dir, "orders").write.saveAsTable(f"{schema}.{spec.table}")
        specs.append(CheckSpec(**{**spec.__dict__, "table": f"{schema}.{spec.table}"}))
    for _ in range(2):
        monitor.run(spark, specs, f"{schema}.history", NOW)
    history = spark.table(f"{schema}.history")
    return q.daily_breaches(history).select(
        "layer", F.regexp_extract("table", r"[^.]+$", 0).alias("table_name"),
        F.col("run_date").cast("string").alias("run_date"), "checks_run", "breaches")


def monitor_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest result of every check, from a history of one run per event day."""
    events = read(spark, sf_dir, "events")
    history = events.groupBy(F.col("event_type").alias("table"), F.to_date("ts").alias("day")).agg(
        F.max("value").alias("metric")).select(
        "table", F.lit("bronze").alias("layer"), F.lit("highest_value").alias("check"), "metric",
        F.lit(100.0).alias("threshold"), (F.col("metric") <= 100).alias("passed"),
        F.col("day").cast("timestamp").alias("run_ts"))
    return q.latest_results(history).drop("run_ts")


def _result(table: str, layer: str, check: str, metric: str, threshold: str, passed: str, source: str) -> str:
    return (f"SELECT '{table}' AS \"table\", '{layer}' AS layer, '{check}' AS \"check\", "
            f"{rounded(metric, 6)} AS metric, CAST({threshold} AS DOUBLE) AS threshold, "
            f"{passed} AS passed FROM {source}")


def _union(*selects: str) -> str:
    return " UNION ALL ".join(selects)


_AGE = "epoch_us(TIMESTAMP '2024-02-01') / 1e6 - epoch_us(max(ts)) / 1e6"
_GAPS = """(SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority,
            CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey FROM orders)"""
_FAILS = """o_totalprice NOT BETWEEN 1000 AND 400000 OR o_orderstatus NOT IN ('F', 'O')
            OR NOT (o_orderpriority <> '1-URGENT' OR o_totalprice > 50000)"""


def _null_rate(column: str) -> str:
    rate = f"avg(CASE WHEN {column} IS NULL THEN 1e0 ELSE 0e0 END)"
    return _result("orders", "silver", f"null_rate:{column}", rate, "0.25", f"{rate} <= 0.25", _GAPS)


def _copies(table: str, keys: str) -> str:
    return f"(SELECT {keys}, count(*) AS n FROM {table} GROUP BY ALL)"


_LAST_DAY = """(SELECT abs(n - base) / base AS dev FROM (
     SELECT d, n, avg(n) OVER (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS base
     FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL)) ORDER BY d DESC LIMIT 1)"""

_SHIFT = f"""
  WITH sides AS (
    SELECT CAST(floor(o_totalprice / 50000.0) AS BIGINT) AS bin,
           count(*) FILTER (WHERE year(o_orderdate) < 1998) AS b,
           count(*) FILTER (WHERE year(o_orderdate) >= 1998) AS c FROM orders GROUP BY ALL),
  shares AS (SELECT bin, b / (sum(b) OVER () + 0e0) AS p, c / (sum(c) OVER () + 0e0) AS q FROM sides),
  floored AS (SELECT *, greatest(p, 1e-6) AS lo, greatest(q, 1e-6) AS hi FROM shares)
  SELECT bin, {rounded('p', 6)} AS baseline_share, {rounded('q', 6)} AS current_share,
         {rounded('(hi - lo) * ln(hi / lo)', 6)} AS stability_part,
         {rounded('abs(q - p) / 2', 6)} AS variation_part
  FROM floored"""

_RULES_SQL = _union(
    _result("orders", "silver", "rule:key_not_negative",
            "count(*) FILTER (WHERE NOT coalesce(o_custkey >= 0, false))", "0",
            "count(*) FILTER (WHERE NOT coalesce(o_custkey >= 0, false)) = 0", _GAPS),
    _result("orders", "silver", "rule:priority_known",
            "count(*) FILTER (WHERE NOT coalesce(o_orderpriority LIKE '_-%', false))", "0",
            "count(*) FILTER (WHERE NOT coalesce(o_orderpriority LIKE '_-%', false)) = 0", _GAPS))

QUERIES = {
    "dq_freshness": Query(dq_freshness, _union(
        _result("events", "bronze", "within_day", _AGE, "86400", f"{_AGE} <= 86400", "events"),
        _result("events", "bronze", "within_week", _AGE, "604800", f"{_AGE} <= 604800", "events"))),
    "dq_volume": Query(dq_volume, f"""
        SELECT run, row_count, file_count, {rounded('base', 6)} AS baseline,
               {rounded('abs(row_count - base) / base', 6)} AS deviation,
               coalesce(abs(row_count - base) / base > 0.02, false) AS breached
        FROM (SELECT *, avg(row_count) OVER (ORDER BY run ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS base
              FROM (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run, count(*) AS row_count,
                           count(DISTINCT event_type) AS file_count FROM events GROUP BY ALL))"""),
    "dq_drift": Query(dq_drift, _union(
        _result("part", "bronze", "rescued_rate", "avg(CASE WHEN p_brand = 'Brand#7' THEN 1e0 ELSE 0e0 END)",
                "0", "count(*) FILTER (WHERE p_brand = 'Brand#7') = 0", "part"),
        _result("part", "bronze", "added_columns", "1", "0", "false", "(SELECT 1)"))),
    "dq_duplicates": Query(dq_duplicates, _union(
        _result("lineitem by key", "bronze", "duplicate_rate", "1 - count(*) / (sum(n) + 0e0)", "NULL", "true",
                _copies("lineitem", "l_orderkey, l_linenumber")),
        _result("lineitem by row", "bronze", "duplicate_rate", "1 - count(*) / (sum(n) + 0e0)", "NULL", "true",
                "(SELECT l, count(*) AS n FROM lineitem l GROUP BY l)"),
        _result("lineitem by flag", "bronze", "duplicate_rate", "1 - count(*) / (sum(n) + 0e0)", "0.5",
                "1 - count(*) / (sum(n) + 0e0) <= 0.5", _copies("lineitem", "l_returnflag")),
        _result("orders by moved status", "bronze", "duplicate_rate", "1 - count(*) / (sum(n) + 0e0)", "NULL", "true",
                "(SELECT a, b, count(*) AS n FROM (SELECT o_orderkey, NULL AS a, o_orderstatus AS b FROM orders UNION ALL "
                "SELECT o_orderkey, o_orderstatus, NULL FROM orders) GROUP BY o_orderkey, a, b)"))),
    "dq_locate": Query(dq_locate, """
        WITH copy AS (
          SELECT * REPLACE (CASE WHEN l_orderkey % 997 = 5 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
          FROM lineitem WHERE NOT (l_orderkey % 1009 = 7 AND l_linenumber = 1)
          UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 1501 = 11
          UNION ALL SELECT * REPLACE (l_orderkey + 100000000 AS l_orderkey) FROM lineitem WHERE l_orderkey % 2003 = 1
        ), unlike AS (
          (SELECT DISTINCT l_orderkey FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM copy))
          UNION (SELECT DISTINCT l_orderkey FROM (SELECT * FROM copy EXCEPT ALL SELECT * FROM lineitem)))
        SELECT l_orderkey, (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = u.l_orderkey) AS left_rows,
               (SELECT count(*) FROM copy c WHERE c.l_orderkey = u.l_orderkey) AS right_rows
        FROM unlike u"""),
    "dq_quarantine": Query(dq_quarantine, f"""
        SELECT o_orderkey, concat_ws(',',
                 CASE WHEN o_totalprice NOT BETWEEN 1000 AND 400000 THEN 'price_in_range' END,
                 CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status_known' END,
                 CASE WHEN NOT (o_orderpriority <> '1-URGENT' OR o_totalprice > 50000) THEN 'urgent_is_dear' END
               ) AS failed
        FROM orders WHERE {_FAILS}"""),
    "dq_quarantine_rate": Query(dq_quarantine_rate, _result(
        "orders", "silver", "quarantine_rate", f"avg(CASE WHEN {_FAILS} THEN 1e0 ELSE 0e0 END)", "0.5",
        f"avg(CASE WHEN {_FAILS} THEN 1e0 ELSE 0e0 END) <= 0.5", "orders")),
    "dq_nulls": Query(dq_nulls, _union(*map(_null_rate, ["o_orderkey", "o_custkey", "o_orderpriority"]))),
    "dq_rules": Query(dq_rules, _RULES_SQL),
    "dq_observed": Query(dq_observed, _union(_RULES_SQL, *map(_null_rate, ["o_orderkey", "o_custkey", "o_orderpriority"]))),
    "dq_keys": Query(dq_keys, _union(
        _result("orders", "silver", "null_keys", "count(*) FILTER (WHERE o_custkey IS NULL)", "0",
                "count(*) FILTER (WHERE o_custkey IS NULL) = 0", _GAPS),
        _result("orders", "silver", "duplicate_keys", "count(*) FILTER (WHERE n > 1 AND o_custkey IS NOT NULL)",
                "0", "count(*) FILTER (WHERE n > 1 AND o_custkey IS NOT NULL) = 0", _copies(_GAPS, "o_custkey")),
        _result("lineitem", "silver", "null_keys", "count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL)",
                "0", "count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) = 0", "lineitem"),
        _result("lineitem", "silver", "duplicate_keys", "count(*) FILTER (WHERE n > 1)", "0",
                "count(*) FILTER (WHERE n > 1) = 0", _copies("lineitem", "l_orderkey, l_linenumber")))),
    "dq_reconcile": Query(dq_reconcile, """
        SELECT count(*) AS bronze_rows,
               count(DISTINCT (l_orderkey, l_linenumber)) FILTER (WHERE l_discount > 0) AS kept_rows,
               count(*) FILTER (WHERE NOT l_discount > 0) AS quarantined_rows,
               count(*) FILTER (WHERE l_discount > 0)
                 - count(DISTINCT (l_orderkey, l_linenumber)) FILTER (WHERE l_discount > 0) AS deduplicated_rows,
               CAST(0 AS BIGINT) AS unexplained_rows FROM lineitem"""),
    "dq_lost_keys": Query(dq_lost_keys, """
        SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""),
    "dq_distribution": Query(dq_distribution, _SHIFT),
    "dq_distribution_score": Query(dq_distribution_score, f"""
        WITH sides AS (
          SELECT event_type,
                 count(*) FILTER (WHERE day(ts) <= 15 AND event_type <> 'signup') AS b,
                 count(*) FILTER (WHERE day(ts) > 15) AS c FROM events GROUP BY ALL),
        shares AS (SELECT b / (sum(b) OVER () + 0e0) AS p, c / (sum(c) OVER () + 0e0) AS q FROM sides)
        SELECT {rounded('sum((greatest(q, 1e-6) - greatest(p, 1e-6)) * ln(greatest(q, 1e-6) / greatest(p, 1e-6)))', 4)}
                 AS stability_index,
               {rounded('sum(abs(q - p) / 2)', 6)} AS total_variation FROM shares"""),
    "monitor_results": Query(monitor_results, _union(
        _result("events_bronze", "bronze", "freshness_seconds", _AGE, "86400", f"{_AGE} <= 86400", "events"),
        _result("events_bronze", "bronze", "added_columns", "1", "0", "false", "(SELECT 1)"),
        _result("events_bronze", "bronze", "volume_deviation", "dev", "0.5", "dev <= 0.5", _LAST_DAY),
        _result("events_bronze", "bronze", "duplicate_rate", "1 - count(*) / (sum(n) + 0e0)", "NULL", "true",
                _copies("events", "event_id")),
        _result("orders_silver", "silver", "rule:price_positive", "count(*) FILTER (WHERE NOT o_totalprice > 0)",
                "0", "count(*) FILTER (WHERE NOT o_totalprice > 0) = 0", "orders"),
        _result("orders_silver", "silver", "rule:status_known",
                "count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O'))", "0",
                "count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) = 0", "orders"),
        _result("orders_silver", "silver", "null_rate:o_custkey",
                "avg(CASE WHEN o_custkey IS NULL THEN 1e0 ELSE 0e0 END)", "0",
                "count(*) FILTER (WHERE o_custkey IS NULL) = 0", "orders"),
        _result("orders_silver", "silver", "quarantine_rate",
                "avg(CASE WHEN o_totalprice > 0 AND o_orderstatus IN ('F', 'O') THEN 0e0 ELSE 1e0 END)", "NULL",
                "true", "orders"),
        _result("orders_silver", "silver", "null_keys", "count(*) FILTER (WHERE o_orderkey IS NULL)", "0",
                "count(*) FILTER (WHERE o_orderkey IS NULL) = 0", "orders"),
        _result("orders_silver", "silver", "duplicate_keys", "count(*) FILTER (WHERE n > 1)", "0",
                "count(*) FILTER (WHERE n > 1) = 0", _copies("orders", "o_orderkey")))),
    "monitor_history": Query(monitor_history, """
        SELECT 'silver' AS layer, 'orders_silver' AS table_name, '2024-02-01' AS run_date,
               CAST(12 AS BIGINT) AS checks_run,
               2 * CAST(count(*) FILTER (WHERE o_totalprice <= 0) > 0 AS BIGINT)
               + 2 * CAST(count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) > 0 AS BIGINT)
               + 2 * CAST(count(*) FILTER (WHERE o_custkey IS NULL) > 0 AS BIGINT)
               + 2 * CAST(count(*) FILTER (WHERE o_orderkey IS NULL) > 0 AS BIGINT)
               + 2 * CAST(count(DISTINCT o_orderkey) < count(o_orderkey) AS BIGINT) AS breaches
        FROM orders"""),
    "monitor_latest": Query(monitor_latest, """
        SELECT event_type AS "table", 'bronze' AS layer, 'highest_value' AS "check", max(value) AS metric,
               CAST(100 AS DOUBLE) AS threshold, max(value) <= 100 AS passed
        FROM events e
        WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events i WHERE i.event_type = e.event_type)
        GROUP BY event_type"""),
}
