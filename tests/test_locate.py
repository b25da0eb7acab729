"""Differences of two tables located by checksums of key ranges."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltworks.operators import locate
from siltworks.operators.locate import locate_differences

from .plans import plan_text

ROW = "k long, a string, b double"


def _expected(left, right):
    by_key = lambda rows: {k: Counter(r for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    a, b = by_key(left), by_key(right)
    return sorted(((k, sum(a.get(k, Counter()).values()), sum(b.get(k, Counter()).values()))
                   for k in {*a, *b} if a.get(k) != b.get(k)), key=repr)


@pytest.mark.parametrize("leaf,most,fanout", [(1024, 1024, 64), (4, 1024, 4), (2, 3, 8), (1, 1, 2)])
def test_planted_differences(spark, monkeypatch, leaf, most, fanout):
    for name, value in (("LEAF", leaf), ("MOST", most), ("FANOUT", fanout)):
        monkeypatch.setattr(locate, name, value)
    rng = random.Random(leaf)
    left = [(rng.randint(-900, 900), rng.choice(["x", None, "y"]), rng.choice([None, 1.5])) for _ in range(700)]
    left += [(None, "n", 1.0), (5, "x", None), (5, "x", None)]
    right = [r for r in left if r[0] is None or r[0] % 97 != 3]
    right = [(k, None if a == "x" and b is None else a, "x" and b) if k is not None and k % 89 == 1 else (k, a, b) for k, a, b in right]
    right += [(None, "n", 2.0), (4000, "new", None), (5, "x", None)]
    rng.shuffle(right)
    found = locate_differences(spark.createDataFrame(left, ROW), spark.createDataFrame(right, ROW), "k").collect()
    assert sorted((tuple(r) for r in found), key=repr) == _expected(left, right)


def test_equal_and_empty_tables(spark):
    rows = spark.createDataFrame([(k, "x", 1.0) for k in range(50)] + [(None, None, None)], ROW)
    empty = rows.limit(0)
    assert locate_differences(rows, rows.orderBy(F.desc("k")).repartition(7), "k").count() == 0
    assert locate_differences(empty, empty, "k").count() == 0
    assert locate_differences(rows, empty, "k").count() == 51
    swapped = spark.createDataFrame([(1, None, 1.0)], ROW), spark.createDataFrame([(1, "x", None)], ROW)
    assert locate_differences(*swapped, "k").count() == 1


def test_only_ranges_that_differ_are_read(spark, scratch):
    path = scratch()
    spark.range(0, 100_000, numPartitions=4).select(F.col("id").alias("k"), F.lit("x").alias("a")).write.parquet(path)
    left = spark.read.parquet(path)
    right = left.withColumn("a", F.when(F.col("k") == 70_001, "y").otherwise(F.col("a")))
    found = locate_differences(left, right, "k")
    assert [tuple(r) for r in found.collect()] == [(70_001, 1, 1)]
    text = plan_text(found)
    assert "GreaterThanOrEqual(k,69632)" in text and "LessThan(k,70656)" in text
