"""Plans that large data depends on."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from siltworks.operators.changes import current_rows
from siltworks.operators.clean import first_per_key, keep_members
from siltworks.operators.quality import repeat_counts, duplicate_rate, measure
from siltworks.operators.summarize import spread_summary
from siltworks.streaming.replay import ChangeState

from .plans import plan_text


def stored(spark, scratch):
    path = scratch()
    spark.range(1000).select("id", (F.col("id") % 7).alias("k"), F.rand(1).alias("v"),
                             F.lit("I").alias("_op"), F.lit("wide").alias("unused")).write.parquet(path)
    return spark.read.parquet(path)


def below_shuffle(plan):
    """The part of the plan that runs before the first shuffle, read from the scan upwards."""
    return plan[plan.rindex("Exchange"):]


def test_one_row_per_key_is_cut_before_the_shuffle(spark, scratch):
    df = stored(spark, scratch)
    for result in (first_per_key(df, ["k"], ["v"]), current_rows(df, ["k"], ["v"])):
        assert re.search(r"WindowGroupLimit .*Partial", below_shuffle(plan_text(result)))


def test_aggregates_combine_before_the_shuffle(spark, scratch):
    df = stored(spark, scratch)
    assert "partial_avg" in below_shuffle(plan_text(spread_summary(df, ["k"], "v")))
    rate = plan_text(measure(repeat_counts(df, ["k"]), "t", "bronze", [duplicate_rate()]))
    assert "partial_count" in below_shuffle(rate)
    assert re.search(r"ReadSchema: struct<k:bigint>", rate)


def test_member_list_reaches_the_scan_and_columns_are_pruned(spark, scratch):
    plan = plan_text(keep_members(stored(spark, scratch), "k", [1, 2, 3]).select("id", "k"))
    assert "PushedFilters: [In(k, [1,2,3])]" in plan
    assert "ReadSchema: struct<id:bigint,k:bigint>" in plan


def test_unchanged_base_rows_are_not_shuffled(spark, scratch):
    df = stored(spark, scratch).select("k", "id", "_op")
    state = ChangeState(spark, scratch(), df.schema, ["k"], ["id"])
    state.apply(df, 0)
    state.compact()
    state.apply(df.where("k = 3").withColumn("id", F.col("id") + 5000), 1)
    untouched = plan_text(state.newest()).split("Union")[1]
    first_join = untouched.index("LeftAnti")
    assert "BroadcastHashJoin" in untouched[:first_join]
    assert "Exchange hashpartitioning" not in untouched[:untouched.index("FileScan")]
    assert sorted(r.id for r in state.current().where("k = 3").collect()) == [5997]
