from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from siltworks.operators.changes import overlapping_versions, version_history
from siltworks.operators.rank import (_place, global_rank, group_rank,
                                      overall_and_group_rank, rolling_baseline, with_next, with_position)

from .plans import plan_text


def sample(spark, seed, rows=3000):
    """A third of all rows in group 'a', a NULL group, many ties and NULL scores."""
    rng = random.Random(seed)
    data = [(i, rng.choice("aabcd") if rng.random() > 0.05 else None,
             rng.choice([None, 1.0, 1.0, 2.0, rng.random()])) for i in range(rows)]
    return spark.createDataFrame(data, "id long, g string, v double").repartition(5)


def order():
    return [F.col("v").desc_nulls_last(), F.col("id")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_global_rank_equals_plain_window(spark, seed):
    df = sample(spark, seed)
    plain = df.withColumn("r", F.row_number().over(Window.orderBy(*order())).cast("long"))
    assert sorted(global_rank(df, order(), "r").collect(), key=str) == sorted(plain.collect(), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_both_ranks_equal_plain_windows(spark, seed):
    df = sample(spark, seed)
    plain = df.withColumns({
        "o": F.row_number().over(Window.orderBy(*order())).cast("long"),
        "w": F.row_number().over(Window.partitionBy("g").orderBy(*order())).cast("long")})
    got = overall_and_group_rank(df, order(), "o", ["g"], "w")
    assert got.columns == plain.columns
    assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)


@pytest.mark.parametrize("rows", [0, 1, 7, 3000])
def test_group_rank_equals_plain_window(spark, rows):
    df = sample(spark, 7, rows)
    plain = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order())).cast("long"))
    assert sorted(group_rank(df, ["g"], order(), "r").collect(), key=str) == \
        sorted(plain.collect(), key=str)


@pytest.mark.parametrize("rows", [0, 1, 7, 3000])
def test_next_row_equals_lead(spark, rows):
    df = sample(spark, 8, rows)
    plain = df.withColumn("n", F.lead("id").over(Window.partitionBy("g").orderBy(*order())))
    assert sorted(with_next(df, ["g"], order(), {"n": "id"}).collect(), key=str) == \
        sorted(plain.collect(), key=str)


def test_one_null_group_can_fill_the_table(spark):
    df = spark.range(200).select("id", F.lit(None).cast("string").alias("g"), (-F.col("id")).alias("v"))
    got = group_rank(df, ["g"], ["v"], "r").collect()
    assert sorted((r.id, r.r) for r in got) == [(i, 200 - i) for i in range(200)]


def test_a_group_over_many_slices_has_no_task_of_its_own(spark):
    """A range shuffle (staged) and one hash shuffle by slice and group; all else is one row per slice or group and slice."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = sample(spark, 9)
        for result in (overall_and_group_rank(df, order(), "o", ["g"], "w"), group_rank(df, ["g"], order(), "r"),
                       with_next(df, ["g"], order(), {"n": "id"})):
            plan = plan_text(result)
            whole = [line for line in plan.splitlines() if "Exchange hashpartitioning(_slice" in line and "_key" in line]
            assert whole and not [line for line in plan.splitlines() if "Exchange hashpartitioning(_key" in line
                                  and "_placed" in line]
            assert "coalesce(g" not in plan and "isnull(g" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_spread_over_slices_although_scores_tie(spark):
    df = spark.range(4000).select("id", F.lit(1.0).alias("v"))
    placed = df.repartitionByRange(8, "v", "id").groupBy(F.spark_partition_id()).count()
    assert placed.count() == 8 and placed.agg(F.max("count")).first()[0] < 2000


def test_rows_are_placed_in_several_slices(spark):
    placed = _place(sample(spark, 1), order())
    assert placed.select("_slice").distinct().count() == 8


def test_global_rank_has_no_window_over_rows(spark):
    plan = plan_text(with_position(sample(spark, 1), order(), "r"))
    windows = [line for line in plan.splitlines() if " Window " in line]
    assert len(windows) == 1 and "sum(_size" in windows[0]


def test_positions_do_not_change_when_read_again(spark):
    ranked = global_rank(sample(spark, 5).select("v"), [F.col("v")], "r")
    assert sorted(ranked.collect(), key=str) == sorted(ranked.collect(), key=str)


def test_rolling_baseline(spark):
    runs = spark.createDataFrame([(d, d * 10) for d in range(1, 6)], "run int, rows int")
    got = rolling_baseline(runs, [], "run", "rows", 2, "base").orderBy("run").collect()
    assert [r.base for r in got] == [None, 10.0, 15.0, 25.0, 35.0]


def test_version_history_and_overlaps(spark):
    log = spark.createDataFrame([(1, 1, "I"), (1, 5, "U"), (1, 9, "D"), (2, 3, "I"), (1, 12, "I")],
                                "k int, t int, _op string")
    history = version_history(log, ["k"], ["t"])
    got = sorted((r.k, r.valid_from, r.valid_to, r.is_current) for r in history.collect())
    assert got == [(1, 1, 5, False), (1, 5, 9, False), (1, 12, None, True), (2, 3, None, True)]
    assert overlapping_versions(history, ["k"]).count() == 0
    crossed = spark.createDataFrame([(1, 1, 6), (1, 5, 9), (1, 9, None), (2, 1, None), (2, 4, None)],
                                    "k int, valid_from int, valid_to int")
    found = overlapping_versions(crossed, ["k"]).collect()
    assert sorted((r.k, r.valid_from) for r in found) == [(1, 1), (2, 1)]
