from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltworks.config import CheckSpec
from siltworks.operators import quality as q
from siltworks.operators.summarize import op_breakdown
from siltworks.plans import monitor

from .plans import plan_text


def by_check(df):
    return {r.check: (r.metric, r.passed) for r in df.collect()}


def test_sla_text():
    assert [q.sla_seconds(t) for t in ("90s", "30m", "24h", "7D", " 1w ")] == [90, 1800, 86400, 604800, 604800]
    with pytest.raises(ValueError):
        q.sla_seconds("soon")


def test_plain_measures_share_one_scan(spark, scratch, now):
    path = scratch()
    df = spark.createDataFrame([(1, -1.0, "new"), (None, 5.0, None), (3, None, "bad")],
                               "k int, amount double, status string")
    df.write.parquet(path)
    measures = [q.null_keys(["k"]), *q.null_rates(["k", "amount"], 0.4),
                *q.rule_breaches({"positive": "amount >= 0", "known": "status IN ('new', 'shipped')"}),
                q.quarantine_rate({"positive": "amount >= 0"})]
    result = q.measure(spark.read.parquet(path), "t", "silver", measures, now)
    assert result.columns == q.RESULT_COLUMNS
    assert plan_text(result).count("FileScan") == 1
    got = by_check(result)
    assert got["null_keys"] == (1.0, False) and got["null_rate:k"] == (pytest.approx(1 / 3), True)
    assert got["rule:positive"] == (2.0, False) and got["rule:known"] == (2.0, False)
    assert got["quarantine_rate"] == (pytest.approx(2 / 3), True)


def test_freshness(spark, now):
    at = lambda **ago: spark.createDataFrame([(now - dt.timedelta(**ago),)], "_ingest_ts timestamp")
    check = lambda df: by_check(q.measure(df, "t", "bronze", [q.freshness("_ingest_ts", "24h", now)], now))
    assert check(at(hours=23)) == {"freshness_seconds": (82800.0, True)}
    assert check(at(hours=25)) == {"freshness_seconds": (90000.0, False)}
    assert check(at(hours=1).limit(0)) == {"freshness_seconds": (None, False)}


def test_volume(spark):
    counts = {1: 10, 2: 10, 3: 10, 4: 30}
    df = spark.createDataFrame([(run, f"f{i % 3}") for run, n in counts.items() for i in range(n)],
                               "run int, file string")
    got = {r.run: r for r in q.volume_runs(df, "run", 0.5, 2, file_column="file").collect()}
    assert (got[1].baseline, got[1].deviation, got[1].breached) == (None, None, False)
    assert (got[4].row_count, got[4].file_count, got[4].baseline) == (30, 3, 10.0)
    assert got[4].deviation == 2.0 and got[4].breached and not got[3].breached


def test_repeats_and_keys(spark, now):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    keys, rows = q.repeat_counts(df, ["k"]), q.repeat_counts(df)
    assert by_check(q.measure(keys, "t", "silver", [q.duplicate_keys(["k"]), q.duplicate_rate()], now)) == {
        "duplicate_keys": (1.0, False), "duplicate_rate": (pytest.approx(0.6), True)}
    assert by_check(q.measure(rows, "t", "bronze", [q.duplicate_rate(0.1)], now)) == {
        "duplicate_rate": (pytest.approx(0.2), False)}


def test_quarantine_splits_every_row_once(spark):
    df = spark.createDataFrame([(1, 5.0, "x"), (2, -5.0, "x"), (3, None, None)], "k int, amount double, s string")
    rules = {"amount_ok": "amount >= 0", "s_known": "s = 'x'"}
    kept, quarantined = q.quarantine(df, rules)
    assert [r.k for r in kept.collect()] == [1] and kept.columns == df.columns
    assert {r.k: r._failed for r in quarantined.collect()} == {2: ["amount_ok"], 3: ["amount_ok", "s_known"]}
    sums = q.reconcile(df, kept, quarantined).first()
    assert (sums.bronze_rows, sums.kept_rows, sums.quarantined_rows, sums.unexplained_rows) == (3, 1, 2, 0)
    assert q.reconcile(df, kept, quarantined.limit(1), 0).first().unexplained_rows == 1
    assert [r.k for r in q.lost_keys(df, [kept, quarantined.where("k = 2")], ["k"]).collect()] == [3]


def test_missing_files(spark, scratch):
    from siltworks.functions import with_lineage
    from siltworks.sources.files import list_files

    root = scratch("with space")
    for n in range(3):
        spark.range(1).coalesce(1).write.parquet(f"{root}/{n}")
    landed = list_files(spark, root, "*.parquet")
    ingested = with_lineage(spark.read.parquet(f"{root}/0", f"{root}/2"), source_file="_source_file")
    assert ["/1/" in r.file_path for r in q.missing_files(landed, ingested).collect()] == [True]


def test_version_faults(spark):
    history = spark.createDataFrame([(1, 1, 5, False), (1, 4, None, True), (2, 1, None, True), (2, 2, None, True)],
                                    "k int, valid_from int, valid_to int, is_current boolean")
    got = q.version_faults(history, ["k"]).first()
    assert (got.keys_with_several_current, got.overlapping_versions) == (1, 2)


def test_distribution(spark):
    same = spark.createDataFrame([("a",), ("b",)], "c string")
    moved = spark.createDataFrame([("b",), ("c",)], "c string")
    still = q.shift_score(q.distribution_shift(same, same, F.col("c"))).first()
    assert (still.stability_index, still.total_variation) == (0.0, 0.0)
    shift = q.distribution_shift(same, moved, F.col("c"))
    assert {r.bin: (r.baseline_share, r.current_share) for r in shift.collect()} == {
        "a": (0.5, 0.0), "b": (0.5, 0.5), "c": (0.0, 0.5)}
    assert q.shift_score(shift).first().total_variation == 0.5


def test_alert_only_when_breached(spark):
    df = spark.createDataFrame([(26,), (27,), (30,)], "players_used int")
    assert q.alert_on_count(df, "players_used > 26").first().records_breached == 2
    assert q.alert_on_count(df, "players_used > 30").count() == 0


def test_op_breakdown(spark):
    log = spark.createDataFrame([("I",), ("I",), ("D",)], "_op string")
    got = op_breakdown({"a": log, "b": spark.range(2)})
    assert sorted((tuple(r) for r in got.collect()), key=str) == [("a", "D", 1, 3), ("a", "I", 2, 3), ("b", None, 2, 2)]
    with pytest.raises(ValueError):
        op_breakdown({})


def test_monitor_by_layer(spark, schema, now):
    rows = [(1, now, None), (2, now - dt.timedelta(days=2), "{}")]
    spark.createDataFrame(rows, "id int, _ingest_ts timestamp, _rescued_data string").write.saveAsTable(
        f"{schema}.orders_bronze")
    spark.createDataFrame([(1, 5.0, "new"), (1, -1.0, "odd")], "order_id int, total_amount double, status string"
                          ).write.saveAsTable(f"{schema}.orders_silver")
    specs = [CheckSpec(f"{schema}.orders_bronze", "bronze", freshness_sla="24h", volume_tolerance=0.5,
                       expected_columns=["id"]),
             CheckSpec(f"{schema}.orders_silver", "silver", primary_keys=["order_id"],
                       checks={"total_non_negative": "total_amount >= 0",
                               "status_known": "status IN ('new','shipped','cancelled')"})]
    failed = {(r.layer, r.check) for r in monitor.run(spark, specs, f"{schema}.history", now).collect()}
    assert failed == {("bronze", "rescued_rate"), ("silver", "duplicate_keys"),
                      ("silver", "rule:total_non_negative"), ("silver", "rule:status_known")}
    later = now + dt.timedelta(days=1, hours=1)
    assert ("bronze", "freshness_seconds") in {
        (r.layer, r.check) for r in monitor.run(spark, specs, f"{schema}.history", later).collect()}
    history = spark.table(f"{schema}.history")
    assert history.columns == [*q.RESULT_COLUMNS, "run_date"]
    latest = q.latest_results(history)
    assert latest.count() * 2 == history.count()
    assert {r.run_ts for r in latest.collect()} == {later.replace(tzinfo=None)}
    days = {(r.layer, str(r.run_date)): r.breaches for r in q.daily_breaches(history).collect()}
    assert days[("bronze", "2024-02-01")] == 1 and days[("bronze", "2024-02-02")] == 2


def test_specs_of_discovered_tables(spark, schema):
    for name in ("a_bronze", "b_bronze", "a_silver"):
        spark.range(1).write.saveAsTable(f"{schema}.{name}")
    declared = [CheckSpec(f"{schema}.b_bronze", "bronze", freshness_sla="1h"),
                CheckSpec(f"{schema}.a_silver", "silver", primary_keys=["id"])]
    specs = monitor.discovered_specs(spark, schema, declared, freshness_sla="24h")
    assert [(s.table.split(".")[1], s.layer, s.freshness_sla) for s in specs] == [
        ("b_bronze", "bronze", "1h"), ("a_silver", "silver", None), ("a_bronze", "bronze", "24h")]


def test_spec_needs_known_layer_and_something_to_check(spark):
    with pytest.raises(ValueError, match="layer"):
        CheckSpec("t", "gold")
    with pytest.raises(ValueError, match="names no keys"):
        monitor.results(spark.range(1), CheckSpec("t", "silver"))


def test_measures_taken_while_writing(spark, schema):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (-3, None)], "n int, s string")
    measures = [*q.rule_breaches({"positive": "n > 0"}), *q.null_rates(["n", "s"], 0.5), q.null_keys(["n"])]
    watched, seen = q.observe(rows, measures)
    watched.write.saveAsTable(f"{schema}.t")
    found = q.observed(spark, seen, "t", "silver", measures).drop("run_ts").collect()
    assert found == q.measure(spark.table(f"{schema}.t"), "t", "silver", measures).drop("run_ts").collect()
    plan = watched._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" in plan and plan.count("Scan") == 1
    empty, none = q.observe(rows.limit(0), measures)
    empty.write.mode("append").saveAsTable(f"{schema}.t")
    assert [r.metric for r in q.observed(spark, none, "t", "silver", measures).collect()] == [0.0, None, None, 0.0]
