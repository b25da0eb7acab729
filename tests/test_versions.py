"""Tables replaced by pointing them to a new version."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from siltworks.sinks import tables
from siltworks.sinks.tables import append_table, described, describe_table, old_versions, replace_table, table_location, vacuum


def rows_of(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


@pytest.mark.parametrize("layout", [[], ["d"]])
def test_replaced_tables_keep_what_describes_them(spark, schema, layout):
    table = f"{schema}.t"
    for number in range(4):
        replace_table(spark.range(3).select("id", F.lit(number).alias("v"), (F.col("id") % (number + 1)).alias("d")), table, layout)
        if number == 0:
            describe_table(spark, table, "It's a comment.", {"quality": "silver"})
    assert described(spark, table)[0] == "It's a comment." and described(spark, table)[1]["quality"] == "silver"
    assert rows_of(spark, table) == [(i, 3, i % 4) for i in range(3)]
    assert len(old_versions(spark, table)) == 3
    assert vacuum(spark, table) == [] and len(vacuum(spark, table, 0)) == 3 and old_versions(spark, table) == []
    assert rows_of(spark, table) == [(i, 3, i % 4) for i in range(3)]
    append_table(spark.range(1).select("id", F.lit(9).alias("v"), F.lit(7).cast("long").alias("d")), table, layout)
    assert spark.table(table).count() == 4


def test_columns_that_come_and_go(spark, schema):
    table = f"{schema}.t"
    replace_table(spark.sql("SELECT 1 AS id, 'a' AS nm"), table)
    describe_table(spark, table, "kept", {"quality": "gold"})
    replace_table(spark.sql("SELECT 2 AS id, 'b' AS nm, 2.5D AS price"), table)  # a column comes
    assert rows_of(spark, table) == [(2, "b", 2.5)]
    replace_table(spark.sql("SELECT 3L AS id, 'c' AS nm"), table)  # one goes, one changes
    assert rows_of(spark, table) == [(3, "c")] and spark.table(table).dtypes == [("id", "bigint"), ("nm", "string")]
    replace_table(spark.sql("SELECT 4L AS id, 'x' AS day"), table, ["day"])  # another layout
    assert rows_of(spark, table) == [(4, "x")] and table_location(spark, table).count(schema) == 1
    assert described(spark, table)[0] == "kept" and described(spark, table)[1]["quality"] == "gold"
    assert [t.name for t in spark.catalog.listTables(schema)] == ["t"]


def test_a_managed_table_is_replaced(spark, schema):
    table = f"{schema}.t"
    spark.range(2).write.saveAsTable(table)
    replace_table(spark.range(5), table)
    assert spark.table(table).count() == 5
    assert [path.rsplit("/", 1)[-1] for path, _ in old_versions(spark, table)] == ["t"]
    vacuum(spark, table, 0)
    assert spark.table(table).count() == 5


def test_readers_never_miss_the_table(spark, schema):
    table, stop, seen, errors = f"{schema}.t", threading.Event(), set(), []
    replace_table(spark.range(10), table)

    def look():
        session = spark.newSession()
        while not stop.is_set():
            try:
                session.catalog.refreshTable(table)  # a session of its own has a cache of its own
                seen.add(session.table(table).count())
            except Exception as error:
                errors.append(error)
                return

    reader = threading.Thread(target=look)
    reader.start()
    for n in range(11, 23):
        replace_table(spark.range(n), table)
    stop.set()
    reader.join()
    assert errors == [] and seen <= set(range(10, 23)) and len(seen) > 1


def test_a_failing_write_leaves_the_table(spark, schema):
    table = f"{schema}.t"
    replace_table(spark.range(3), table)
    with pytest.raises(Exception):
        replace_table(spark.range(3).withColumn("id", F.raise_error(F.lit("no")).cast("long")), table)
    assert spark.table(table).count() == 3
    vacuum(spark, table, 0)
    assert spark.table(table).count() == 3 and old_versions(spark, table) == []


def test_names_that_begin_alike_are_left_alone(spark, schema):
    for name in ("t", "t_2"):
        replace_table(spark.range(1), f"{schema}.{name}")
        replace_table(spark.range(2), f"{schema}.{name}")
    assert len(vacuum(spark, f"{schema}.t", 0)) == 1 and len(old_versions(spark, f"{schema}.t_2")) == 1
    assert tables.keeps_files(spark)
