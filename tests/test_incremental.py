"""Partition-wise refresh and mergeable summaries against rebuilding from everything."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from siltworks.operators.moments import Moments, merge_moments, partial_moments, summary_of
from siltworks.operators.summarize import spread_summary
from siltworks.plans import air_quality
from siltworks.sinks.tables import replace_partitions, replace_table

from .plans import plan_text

RAW = "event_id long, revision int, location_id int, locationid int, datetime string, value string, parameter string, units string, location string, lat double, lon double"


def _reading(number, month, value, revision=0, hour=0):
    return (number, revision, 1, 1, f"2024-{month:02d}-03 {hour:02d}:00:00", value, "pm25", "ug/m3", "Loc 1", 1.0, 2.0)


def _prefer():
    return ["event_id", F.col("revision").desc()]


def _all(spark, table):
    return sorted(map(repr, spark.table(table).collect()))


def test_refresh_equals_a_rebuild(spark, schema):
    rng = random.Random(2)
    waves = [[_reading(k, rng.randint(1, 6), str(rng.randint(0, 90)), 0, rng.randint(0, 5)) for k in range(60)],
             [_reading(k, rng.randint(2, 3), str(rng.randint(0, 90)), 0, rng.randint(0, 5)) for k in range(60, 80)],
             [_reading(k, 3, "7.5", 1, rng.randint(0, 5)) for k in range(0, 80, 9)] + [_reading(200, 5, "n/a"), _reading(201, 5, None), _reading(202, 5, "-1")]]
    clean, daily = f"{schema}.clean", f"{schema}.daily"
    seen = []
    for wave in (*waves, waves[1]):  # the last one comes again
        air_quality.refresh(spark.createDataFrame(wave, RAW), clean, daily, _prefer())
        seen += wave
        silver = air_quality.silver(spark.createDataFrame(seen, RAW).distinct(), prefer=_prefer())
        replace_table(silver, f"{schema}.whole", air_quality.MONTH_LAYOUT)
        columns = spark.table(f"{schema}.whole").columns
        assert sorted(map(repr, spark.table(clean).select(columns).collect())) == _all(spark, f"{schema}.whole")
        replace_table(air_quality.gold(spark.table(f"{schema}.whole")), f"{schema}.whole_daily", air_quality.MONTH_LAYOUT)
        assert _all(spark, daily) == _all(spark, f"{schema}.whole_daily")


def test_untouched_months_are_neither_read_nor_written(spark, schema):
    clean, daily = f"{schema}.clean", f"{schema}.daily"
    air_quality.refresh(spark.createDataFrame([_reading(k, 1 + k % 4, "5", 0, k % 20) for k in range(40)], RAW), clean, daily, _prefer())
    files = lambda table, month: set(spark.table(table).where(F.col("measured_month") == month).inputFiles())
    names = lambda month: {r[0] for t in (clean, daily) for r in spark.table(t).where(F.col("measured_month") == month).select(
        F.input_file_name()).distinct().collect()}
    before = {m: names(m) for m in (1, 2, 3, 4)}
    fresh = spark.createDataFrame([_reading(99, 2, "8", 0, 22)], RAW)
    touched = air_quality.months_of(air_quality.silver(fresh, prefer=_prefer()))
    text = plan_text(spark.table(clean).where(touched))
    assert "PartitionFilters: [" in text and "measured_month" in text.split("PartitionFilters: [")[1].split("]")[0]
    air_quality.refresh(fresh, clean, daily, _prefer())
    after = {m: names(m) for m in (1, 2, 3, 4)}
    assert {m for m in after if after[m] != before[m]} == {2} and files(clean, 2)


def test_replaced_partitions_only(spark, schema):
    table = f"{schema}.t"
    replace_partitions(spark.sql("SELECT id, id % 3 AS p FROM range(9)"), table, ["p"])
    replace_partitions(spark.sql("SELECT 100L AS id, 1L AS p"), table, ["p"])
    assert sorted(tuple(r) for r in spark.table(table).collect()) == sorted([(0, 0), (3, 0), (6, 0), (2, 2), (5, 2), (8, 2), (100, 1)])
    replace_partitions(spark.sql("SELECT 7L AS id, 5L AS p, 'new' AS note"), table, ["p"])
    assert spark.table(table).where("note = 'new'").count() == 1 and spark.table(table).count() == 8
    replace_partitions(spark.table(table).limit(0), table, ["p"])
    assert spark.table(table).count() == 8


@pytest.fixture
def values(spark):
    rng = random.Random(7)
    rows = [(k % 5, None if k % 11 == 0 else 1e9 + rng.gauss(0, 1), k % 4) for k in range(400)]
    rows += [(7, 3.5, 0), (8, None, 1), (None, 2.0, 2), (None, 4.0, 3)]
    return spark.createDataFrame(rows, "k int, v double, batch int")


def _stats(df):
    return sorted(tuple(r) for r in df.withColumn("k", F.coalesce("k", F.lit(-1))).collect())


def test_moments_in_any_order(spark, schema, values):
    whole = _stats(spread_summary(values, ["k"], "v"))
    for order in ([0, 1, 2, 3], [3, 1, 0, 2, 1, 3]):
        moments = Moments(f"{schema}.m{len(order)}", ["k"], "v")
        for batch in order:
            moments.add(values.where(F.col("batch") == batch), batch)
        assert _stats(moments.summary(spark)) == whole
        moments.compact(spark, 2)
        assert {r.batch for r in spark.table(moments.table).select("batch").distinct().collect()} == {2, 3}
        moments.add(values.where(F.col("batch") == 3), 3)
        assert _stats(moments.summary(spark)) == whole


def test_moments_keep_small_spreads_of_large_values(spark, values):
    parts = [partial_moments(values.where(F.col("batch") == b), ["k"], "v") for b in range(4)]
    merged = merge_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), ["k"])
    found = {r.k: r.daily_stddev for r in summary_of(merged, ["k"]).collect()}
    assert all(0.7 < found[k] < 1.3 for k in range(5)) and found[7] is None and found[8] is None
    assert merged.where("k = 8").first().n == 0
    assert summary_of(merge_moments(parts[0].limit(0), ["k"]), ["k"]).count() == 0
