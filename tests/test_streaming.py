"""Files landed in waves, bronze tables, schema growth, replay of changes."""

from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.config import Landing, Reading
from siltworks.operators.changes import current_rows
from siltworks.plans import air_quality, change_bronze, shared_landing
from siltworks.plans.datasets import DatasetMap
from siltworks.sources.files import arrow_location, list_files
from siltworks.sources.register import FileRegister
from siltworks.sources.schemas import SchemaLog, conflicting_files, remembered_schema, widen
from siltworks.streaming.fanout import drain_all, finished
from siltworks.streaming.landing import append_stream, distinct_stream, file_stream, partition_stream
from siltworks.streaming.replay import ChangeState, replay_stream


def land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


@pytest.fixture
def config(scratch, schema):
    return Landing(scratch("root"), "shop", schema, state=scratch("checkpoint"))


def raise_any(outcomes):
    for error in outcomes.values():
        if error is not None:
            raise error


def test_two_waves_with_an_added_column(spark, config):
    root = config.folder
    land(spark, [("I", 1, "a"), ("I", 2, "b")], "Op string, id int, nm string", f"{root}/people/2024/01/01")
    raise_any(change_bronze.run(spark, config))
    bronze = config.layout("people").bronze
    assert spark.table(bronze).count() == 2
    raise_any(change_bronze.run(spark, config))
    assert spark.table(bronze).count() == 2  # nothing new
    land(spark, [("U", 1, "a2", 9.5), ("D", 2, "b", None)], "Op string, id int, nm string, sal double",
         f"{root}/people/2024/01/02")
    raise_any(change_bronze.run(spark, config))
    rows = spark.table(bronze)
    assert {"_op", "_ingested_at", "_source_file", "_source_table", "sal"} <= set(rows.columns)
    assert rows.count() == 4 and rows.where("sal IS NULL").count() == 3
    assert {r[0] for r in rows.select("_source_table").distinct().collect()} == {"shop.people"}
    state = current_rows(rows.select("id", "nm", "sal", "_op", "_source_file"), ["id"], ["_source_file"])
    assert [tuple(r) for r in state.select("id", "nm", "sal").collect()] == [(1, "a2", 9.5)]


def test_file_order_sequences_changes(spark, config):
    config = dataclasses.replace(config, row_order=True)
    changes = [("I", 1, "a"), ("U", 1, "b"), ("U", 1, "c"), ("I", 2, "x"), ("D", 2, "x")]
    land(spark, changes[:2], "Op string, id int, nm string", f"{config.folder}/t/2024/01/01")
    land(spark, changes[2:], "Op string, id int, nm string", f"{config.folder}/t/2024/01/02")
    raise_any(change_bronze.run(spark, config))
    log = spark.table(config.layout("t").bronze)
    state = current_rows(log, ["id"], change_bronze.FILE_ORDER)
    assert [(r.id, r.nm) for r in state.collect()] == [(1, "c")]


def test_bad_tables_do_not_stop_a_good_one(spark, config):
    root = config.folder
    land(spark, [("I", 1)], "Op string, id int", f"{root}/good/1")
    land(spark, [(1,)], "id int", f"{root}/no_op/1")
    land(spark, [("I", 1)], "Op string, id int", f"{root}/clash/1")
    land(spark, [("I", "x")], "Op string, id string", f"{root}/clash/2")
    spark.range(1).write.json(f"{root}/no_parquet/1")
    outcomes = change_bronze.run(spark, config)
    assert finished(outcomes) == ["good"]
    assert set(outcomes) == {"good", "no_op", "clash", "no_parquet"}
    assert "_op" in str(outcomes["no_op"]) and "clash" in str(outcomes["clash"])
    got = [tuple(r) for r in change_bronze.summary(spark, config, outcomes).collect()]
    assert got == [("good", "I", 1, 1)]


def test_type_change_of_a_later_wave_is_an_error(spark, config):
    root = config.folder
    land(spark, [("I", 1)], "Op string, id int", f"{root}/t/1")
    raise_any(change_bronze.run(spark, config))
    land(spark, [("I", "x")], "Op string, id string", f"{root}/t/2")
    outcome = change_bronze.run(spark, config)["t"]
    assert "files disagree on column types" in str(outcome) and "/t/2/" in str(outcome)
    assert spark.table(config.layout("t").bronze).count() == 1


def test_misfits_are_rescued_by_a_stream(spark, config):
    config = dataclasses.replace(config, reading=Reading(rescue=True))
    root, bronze = f"{config.folder}/t", config.layout("t").bronze
    land(spark, [("I", 1, 5)], "Op string, id int, qty int", f"{root}/2024/01/01")
    land(spark, [("I", 2, "6"), ("I", 3, "six")], "Op string, id int, qty string", f"{root}/2024/01/02")
    raise_any(change_bronze.run(spark, config))
    got = spark.table(bronze).orderBy("id").select("_op", "id", "qty", "_rescued_data").collect()
    if dict(spark.table(bronze).dtypes)["qty"] == "int":
        assert [tuple(r) for r in got] == [("I", 1, 5, None), ("I", 2, 6, None), ("I", 3, None, '{"qty":"six"}')]
    else:  # the text file came first, and a number fits text
        assert [tuple(r) for r in got] == [("I", 1, "5", None), ("I", 2, "6", None), ("I", 3, "six", None)]
    raise_any(change_bronze.run(spark, config))
    assert spark.table(bronze).count() == 3
    land(spark, [("U", 2**40, 7, "n")], "Op string, id long, qty int, note string", f"{root}/2024/01/03")
    raise_any(change_bronze.run(spark, config))
    row = spark.table(bronze).where("note = 'n'").select("id", "_rescued_data", "_source_table").first()
    assert tuple(row) == (None, '{"id":"%d"}' % 2**40, "shop.t")
    assert spark.table(bronze).where("_source_file IS NULL OR _ingested_at IS NULL").count() == 0


def test_rescue_repeats_nothing_after_a_lost_commit(spark, config):
    config = dataclasses.replace(config, reading=Reading(rescue=True))
    land(spark, [("I", 1)], "Op string, id int", f"{config.folder}/t/1")
    raise_any(change_bronze.run(spark, config))
    again = dataclasses.replace(config, state=config.state + "-lost")
    raise_any(change_bronze.run(spark, again))
    assert spark.table(config.layout("t").bronze).count() == 1


def test_later_runs_open_new_files_only(spark, config):
    land(spark, [("I", 1)], "Op string, id int", f"{config.folder}/t/1")
    raise_any(change_bronze.run(spark, config))
    layout = config.layout("t")
    for row in list_files(spark, layout.landed).collect():  # an old file that can't be read any more does no harm
        arrow_location(row.path)[0].open_output_stream(arrow_location(row.path)[1]).close()
    land(spark, [("I", 2, "n")], "Op string, id int, nm string", f"{config.folder}/t/2")
    raise_any(change_bronze.run(spark, config))
    register = FileRegister.beside(spark, layout.bronze)
    assert register.schemas()[""][0] == 2 and register.schemas()[""][1].names == ["Op", "id", "nm"]
    assert sorted((r.id, r.nm) for r in spark.table(layout.bronze).collect()) == [(1, None), (2, "n")]


def test_csv_changes_by_header(spark, config):
    config = dataclasses.replace(config, reading=Reading("csv", {"sep": ";"}))
    for day, text in (("1", "Op;id;qty\nI;1;5\n"), ("2", "qty;Op;id;note\n5.5;I;2;x\n7;D;3;\n")):
        filesystem, name = arrow_location(f"{config.folder}/t/{day}")
        filesystem.create_dir(name)
        with filesystem.open_output_stream(f"{name}/a.csv") as out:
            out.write(text.encode())
        raise_any(change_bronze.run(spark, config))
    rows = spark.table(config.layout("t").bronze).orderBy("id").select("_op", "id", "qty", "note", "_rescued_data").collect()
    assert [tuple(r) for r in rows] == [("I", 1, 5, None, None), ("I", 2, None, "x", '{"qty":"5.5"}'), ("D", 3, 7, None, None)]
    fixed = dataclasses.replace(config, row_order=True)
    assert "position" in str(change_bronze.run(spark, fixed)["t"])


def test_state_widens_and_is_vacuumed(spark, scratch):
    state = ChangeState(spark, scratch(), T.StructType.fromDDL("id int, _op string, n int"), ["id"], ["n"])
    for number in range(3):
        extra = {2: "'late' AS added"}.get(number, "")
        state.apply(spark.sql(f"SELECT {number % 2} AS id, 'U' AS _op, {number} AS n" + (f", {extra}" if extra else "")), number)
        state.compact()
    assert sorted(tuple(r) for r in state.current().collect()) == [(0, 2, "late"), (1, 1, None)]
    assert state.vacuum() == ["base/v=1", "base/v=2", "changes/v=0", "changes/v=1", "changes/v=2"]
    again = ChangeState(spark, state.location, T.StructType.fromDDL("id int, _op string, n int"), ["id"], ["n"])
    assert sorted(tuple(r) for r in again.current().collect()) == [(0, 2, "late"), (1, 1, None)]


def test_late_files_are_taken_in(spark, scratch, schema):
    import os
    import time

    path, checkpoint = scratch(), scratch()
    for number in range(2):
        land(spark, [(number,)], "id int", f"{path}/p={number}")
        if number:
            for row in list_files(spark, f"{path}/p=1").collect():
                os.utime(arrow_location(row.path)[1], (time.time() - 90 * 86400,) * 2)
        stream = partition_stream(spark, path, "parquet", T.StructType().add("id", T.IntegerType()), p=[0, 1])
        append_stream(stream, f"{schema}.late", checkpoint).awaitTermination()
    assert spark.table(f"{schema}.late").count() == 2


def test_absent_source_is_no_error(spark, config):
    assert change_bronze.run(spark, config) == {}


def test_drain_waits_only_for_its_own(spark, scratch, schema):
    path = scratch()
    land(spark, [(1,)], "id int", path)
    read = lambda: file_stream(spark, path, "parquet", T.StructType().add("id", T.IntegerType()))
    endless = append_stream(read(), f"{schema}.endless", scratch(), every="1 second")
    try:
        outcomes = drain_all({
            "good": lambda: append_stream(read(), f"{schema}.good", scratch()),
            "bad": lambda: append_stream(read().withColumn("x", F.raise_error(F.lit("no"))), f"{schema}.bad", scratch()),
        }, at_once=1)
        assert finished(outcomes) == ["good"] and endless.isActive
        endless.processAllAvailable()
        assert spark.table(f"{schema}.endless").count() == 1
    finally:
        endless.stop()
    assert drain_all({}) == {}


def test_shared_root_routes_by_file_name(spark, scratch, schema, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    def put(day, name, **columns):
        (tmp_path / day).mkdir(exist_ok=True)
        pq.write_table(pa.table(columns), tmp_path / day / f"{name}.parquet")

    put("2024-01-01", "orders", id=[1, 2])
    put("2024-01-01", "people", nm=["a"])
    put("2024-01-02", "orders", id=[3])
    base = scratch()
    raise_any(shared_landing.run(spark, str(tmp_path), schema, base))
    assert spark.table(f"{schema}.orders_bronze").count() == 3
    people = spark.table(f"{schema}.people_bronze").first()
    assert people._source_name == "people" and people._source_file.endswith("2024-01-01/people.parquet")
    put("2024-01-03", "orders", id=[4], note=["n"])
    put("2024-01-03", "late", x=[1])
    outcomes = shared_landing.run(spark, str(tmp_path), schema, base)
    raise_any(outcomes)
    assert sorted(outcomes) == ["late", "orders", "people"]
    got = spark.table(f"{schema}.orders_bronze").orderBy("id").select("id", "note").collect()
    assert [tuple(r) for r in got] == [(1, None), (2, None), (3, None), (4, "n")]
    properties = spark.sql(f"SHOW TBLPROPERTIES {schema}.orders_bronze").collect()
    assert ("quality", "bronze") in [(r.key, r.value) for r in properties]


def test_shared_root_takes_folders_of_part_files_for_tables(spark, scratch, schema):
    root = scratch("landing")
    spark.range(6).repartition(3).write.parquet(f"{root}/orders.parquet")
    spark.range(2).coalesce(1).write.parquet(f"{root}/day/people.parquet")
    outcomes = shared_landing.run(spark, root, schema, scratch())
    raise_any(outcomes)
    assert sorted(outcomes) == ["orders", "people"]
    rows = spark.table(f"{schema}.orders_bronze")
    assert sorted(r.id for r in rows.collect()) == [0, 1, 2, 3, 4, 5] and rows.select("_source_name").distinct().count() == 1


def test_partition_stream_reads_chosen_folders(spark, scratch):
    root = scratch()
    rows = [(i, y, i * 1.5) for i in (1, 2, 3) for y in (2022, 2023, 2024)]
    spark.createDataFrame(rows, "locationid int, year int, value double").write.partitionBy(
        "locationid", "year").option("header", "true").option("compression", "gzip").csv(root)
    wanted = T.StructType().add("value", T.DoubleType()).add("locationid", T.IntegerType()).add("year", T.IntegerType())
    stream = air_quality.bronze_stream(spark, root, wanted, [1, 3], range(2023, 2025))
    query = stream.writeStream.format("memory").queryName("chosen").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r.locationid, r.year, r.value) for r in spark.table("chosen").collect())
    assert got == [(1, 2023, 1.5), (1, 2024, 1.5), (3, 2023, 4.5), (3, 2024, 4.5)]
    assert partition_stream(spark, root, "csv", wanted, locationid=[1]).isStreaming


def test_schema_log_keeps_and_widens(spark, scratch):
    log, path = SchemaLog(spark, scratch("schema")), scratch("files")
    assert log.latest() is None and remembered_schema(spark, log, path, "parquet") is None
    land(spark, [(1,)], "id int", f"{path}/a")
    options = {"recursiveFileLookup": "true"}
    assert remembered_schema(spark, log, path, "parquet", options=options).names == ["id"]
    land(spark, [(2, "x")], "id int, nm string", f"{path}/b")
    assert remembered_schema(spark, log, path, "parquet", False, options).names == ["id"]
    assert remembered_schema(spark, log, path, "parquet", True, options).names == ["id", "nm"]
    assert log.latest().names == ["id", "nm"]
    with pytest.raises(ValueError, match="ID: int -> string"):
        widen(log.latest(), T.StructType().add("ID", T.StringType()))


def test_conflicting_files_are_named(spark, scratch):
    root = scratch("with space")
    for n in range(3):
        land(spark, [(1, "a")], "id int, nm string", f"{root}/ok{n}")
    land(spark, [("1", "a")], "id string, nm string", f"{root}/odd")
    rows = conflicting_files(list_files(spark, root, "*.parquet")).collect()
    assert [(r.column, r.type, r.usual_type) for r in rows] == [("id", "string", "int32")]
    assert "/odd/" in rows[0].path


LOG = "id int, seq int, v string, _op string"
CHANGES = [(1, 1, "a", "I"), (2, 2, "b", "I"), (1, 3, "a2", "U"), (3, 4, "c", "I"), (2, 5, None, "D"),
           (3, 6, "c2", "U"), (4, 7, "d", "I"), (4, 8, None, "D"), (4, 9, "d2", "I")]


def state_of(spark, scratch):
    schema = spark.createDataFrame([], LOG).schema
    return ChangeState(spark, scratch("state"), schema, ["id"], ["seq"])


@pytest.mark.parametrize("cuts", [[9], [3, 6, 9], [1, 2, 3, 4, 5, 6, 7, 8, 9]])
@pytest.mark.parametrize("late_first", [False, True])
def test_state_does_not_depend_on_batches(spark, scratch, cuts, late_first):
    state = state_of(spark, scratch)
    assert state.current().count() == 0
    batches = [CHANGES[a:b] for a, b in zip([0, *cuts], cuts)]
    for n, batch in enumerate(reversed(batches) if late_first else batches):
        state.apply(spark.createDataFrame(batch, LOG), n)
        if n == 1:
            state.compact()
            state.apply(spark.createDataFrame(batch, LOG), n)
    whole = current_rows(spark.createDataFrame(CHANGES, LOG), ["id"], ["seq"])
    assert sorted(state.current().collect()) == sorted(whole.collect())
    assert sorted(tuple(r) for r in whole.collect()) == [(1, 3, "a2"), (3, 6, "c2"), (4, 9, "d2")]
    state.compact()
    state.compact()
    assert sorted(state.current().collect()) == sorted(whole.collect())


def test_unfinished_compaction_is_ignored(spark, scratch):
    state = state_of(spark, scratch)
    state.apply(spark.createDataFrame(CHANGES[:3], LOG), 0)
    spark.createDataFrame([(99, 1, "x", "I")], LOG).write.parquet(f"{state.location}/base/v=1")
    assert sorted(r.id for r in state.current().collect()) == [1, 2]
    state.compact()
    assert state.version() == 1 and sorted(r.id for r in state.current().collect()) == [1, 2]


def test_state_takes_new_columns(spark, scratch):
    location = scratch("state")
    narrow = spark.createDataFrame([(1, 1, "I")], "id int, seq int, _op string")
    ChangeState(spark, location, narrow.schema, ["id"], ["seq"]).apply(narrow, 0)
    wide = spark.createDataFrame([(2, 2, "n", "I")], "id int, seq int, note string, _op string")
    state = ChangeState(spark, location, wide.schema, ["id"], ["seq"])
    state.apply(wide, 1)
    assert sorted(tuple(r) for r in state.current().collect()) == [(1, 1, None), (2, 2, "n")]


def test_replay_stream_in_waves(spark, scratch):
    state, landing, checkpoint = state_of(spark, scratch), scratch("log"), scratch("checkpoint")
    for n in range(3):
        land(spark, CHANGES[n * 3:n * 3 + 3], LOG, f"{landing}/{n}")
        stream = file_stream(spark, landing, "parquet", state.schema)
        replay_stream(stream, state, checkpoint, compact_every=2).awaitTermination()
    assert sorted(tuple(r) for r in state.current().collect()) == [(1, 3, "a2"), (3, 6, "c2"), (4, 9, "d2")]
    assert state.version() == 1


def test_missing_op_is_refused(spark):
    with pytest.raises(ValueError, match="_op"):
        current_rows(spark.range(1), ["id"], ["id"])


def test_declared_datasets(spark, scratch, schema):
    landing = scratch()
    land(spark, [(1,), (2,)], "id int", landing)
    datasets = DatasetMap()

    @datasets.table(comment="it's raw", properties={"quality": "bronze"})
    def raw(session):
        return file_stream(session, landing, "parquet", T.StructType().add("id", T.IntegerType()))

    @datasets.table("total")
    def _(session):
        return session.table(f"{schema}.raw").agg(F.sum("id").alias("s"))

    base = scratch()
    for _ in range(2):
        assert datasets.write_all(spark, schema, base) == ["raw", "total"]
    assert spark.table(f"{schema}.total").first().s == 3
    comment = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {schema}.raw").collect() if r.col_name == "Comment"]
    assert comment == ["it's raw"]


def test_landing_layout():
    layout = Landing("s3a://landing/cdc/mydb", "mydb", "hr_bronze", "main", state="s3a://state").layout("employees")
    assert layout == ("s3a://landing/cdc/mydb/employees/", "main.hr_bronze.employees_raw", "mydb.employees", "s3a://state/mydb/employees")
    assert layout.schemas == "s3a://state/mydb/employees/_schema"
    assert Landing("s3a://l/cdc/mydb/", "mydb", "hr").layout("t").state == "s3a://l/cdc/_checkpoints/hr/mydb/t"
    assert Landing("x", "a", "b", "c", "_log").layout("t").bronze == "c.b.t_log"
    with pytest.raises(TypeError):
        Landing("only a path")
    assert air_quality.PM25_BOUNDS[0].limit == 12.0 and dt.date.today().year > 2000


def test_repeats_are_dropped_over_restarts(spark, scratch, schema):
    path, checkpoint, table = scratch(), scratch(), f"{schema}.once"
    read = lambda: distinct_stream(file_stream(spark, path, "parquet", T.StructType.fromDDL("id int, v string")), ["id"])
    land(spark, [(1, "a"), (1, "a"), (None, "n"), (2, "b")], "id int, v string", f"{path}/1")
    append_stream(read(), table, checkpoint).awaitTermination()
    land(spark, [(2, "b"), (3, "c"), (None, "n")], "id int, v string", f"{path}/2")
    broken = append_stream(read().withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v"))),
                           table, checkpoint)
    with pytest.raises(Exception):
        broken.awaitTermination()
    for _ in range(2):  # the batch that broke off is taken up again
        append_stream(read(), table, checkpoint).awaitTermination()
        assert sorted(((r.id or 0), r.v) for r in spark.table(table).collect()) == [(0, "n"), (1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(ValueError):
        distinct_stream(spark.range(1), ["id"], horizon="1 day")


def test_keys_are_forgotten_after_their_horizon(spark, scratch, schema):
    path, checkpoint, table = scratch(), scratch(), f"{schema}.once"
    read = lambda: distinct_stream(file_stream(spark, path, "parquet", T.StructType.fromDDL("id int, at timestamp")), ["id"], "at", "2 days")
    for number, rows in enumerate([[(1, 1)], [(1, 2), (2, 2)], [(3, 20)], [(1, 21)]]):
        land(spark, [(i, dt.datetime(2024, 1, day)) for i, day in rows], "id int, at timestamp", f"{path}/{number}")
        append_stream(read(), table, checkpoint).awaitTermination()
    assert sorted((r.id, r["at"].day) for r in spark.table(table).collect()) == [(1, 1), (1, 21), (2, 2), (3, 20)]
