"""Batches bound to a schema, the register of files, and crashes at every step of a batch."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from siltworks.config import DomainConfig, Landing, Reading
from siltworks.operators.quality import missing_files
from siltworks.plans import batch_files, change_bronze, shared_landing
from siltworks.sources import register as registers
from siltworks.sources.files import list_files
from siltworks.sources.register import FileRegister
from siltworks.streaming import intake
from siltworks.streaming.intake import Intake, Target

from .plans import plan_text


def land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


@pytest.fixture
def config(scratch, schema):
    return Landing(scratch("root"), "shop", schema, state=scratch("checkpoint"))


def good(outcomes):
    assert all(error is None for error in outcomes.values()), outcomes


def bronze_rows(spark, config, *columns):
    return sorted(tuple(r) for r in spark.table(config.layout("t").bronze).select(*columns).collect())


@pytest.mark.parametrize("step", ["plan", "bind"])
def test_a_column_that_lands_while_a_batch_is_prepared(spark, config, monkeypatch, step):
    """A file with a new column lands between the batch's list of files (or its schema) and its reading."""
    folder = f"{config.folder}/t"
    land(spark, [("I", 1)], "Op string, id int", f"{folder}/1")
    original, landed = getattr(FileRegister, step), []

    def racing(self, *args):
        if not landed:
            landed.append(land(spark, [("I", 2, "NEW")], "Op string, id int, b string", f"{folder}/2"))
        return original(self, *args)

    monkeypatch.setattr(FileRegister, step, racing)
    for _ in range(2):
        good(change_bronze.run(spark, config))
    assert bronze_rows(spark, config, "id", "b") == [(1, None), (2, "NEW")]
    register = FileRegister.beside(spark, config.layout("t").bronze)
    assert register.taken().count() == 2 and register.unfinished() == []


def test_a_column_that_lands_while_a_stream_runs(spark, config):
    folder = f"{config.folder}/t"
    land(spark, [("I", 1)], "Op string, id int", f"{folder}/1")
    query = change_bronze.start_table(spark, config, "t", every="1 second")
    try:
        query.processAllAvailable()
        land(spark, [("I", 2, "NEW")], "Op string, id int, b string", f"{folder}/2")
        query.processAllAvailable()
        land(spark, [("I", 3)], "Op string, id int", f"{folder}/3")
        query.processAllAvailable()
    finally:
        query.stop()
    assert bronze_rows(spark, config, "id", "b") == [(1, None), (2, "NEW"), (3, None)]


class Crash(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["plan", "bind", "append", "finish"])
@pytest.mark.parametrize("rescue", [False, True])
def test_a_crash_at_every_step(spark, config, monkeypatch, step, rescue):
    config = Landing(config.folder, "shop", config.schema, state=config.state, reading=Reading(rescue=rescue))
    folder = f"{config.folder}/t"
    land(spark, [("I", 1), ("I", 2)], "Op string, id int", f"{folder}/1")
    good(change_bronze.run(spark, config))
    land(spark, [("I", 3, "n")], "Op string, id int, b string", f"{folder}/2")

    def crash(*_):
        raise Crash(step)

    with monkeypatch.context() as patch:
        patch.setattr(intake if step == "append" else FileRegister, "append_table" if step == "append" else step, crash)
        assert change_bronze.run(spark, config)["t"] is not None
    land(spark, [("I", 4, "m")], "Op string, id int, b string", f"{folder}/3")
    for _ in range(2):
        good(change_bronze.run(spark, config))
        assert bronze_rows(spark, config, "id", "b") == [(1, None), (2, None), (3, "n"), (4, "m")]
    register = FileRegister.beside(spark, config.layout("t").bronze)
    assert register.unfinished() == [] and register.taken().count() == 3


def test_later_runs_do_not_read_the_table(spark, config, monkeypatch):
    land(spark, [("I", 1)], "Op string, id int", f"{config.folder}/t/1")
    good(change_bronze.run(spark, config))
    bronze = config.layout("t").bronze
    land(spark, [("I", 2)], "Op string, id int", f"{config.folder}/t/2")
    seen, plan = [], FileRegister.plan

    def watched(self, batch, files):
        seen.append(plan_text(files))
        return plan(self, batch, files)

    monkeypatch.setattr(FileRegister, "plan", watched)
    monkeypatch.setattr(intake, "held_files", lambda *_: pytest.fail("the table was asked"))
    good(change_bronze.run(spark, config))
    assert len(seen) == 1 and seen[0].count("FileScan") == 1 and "ReadSchema: struct<file_path:string>" in seen[0]  # the register
    assert spark.table(bronze).count() == 2


def test_held_files_reads_new_data_files_only(spark, scratch, schema):
    table = f"{schema}.t"
    spark.createDataFrame([(1, "old")], "id int, _source_file string").write.saveAsTable(table)
    time.sleep(1.1)
    since = int(time.time() * 1000) + intake._SLACK_MS
    spark.createDataFrame([(2, "new")], "id int, _source_file string").write.mode("append").saveAsTable(table)
    assert {r.file_path for r in intake.held_files(spark, table, since).collect()} == {"new"}
    assert {r.file_path for r in intake.held_files(spark, table, None).collect()} == {"old", "new"}


def test_a_bad_table_of_a_root_is_tried_again(spark, scratch, schema, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    def put(day, name, **columns):
        (tmp_path / day).mkdir(exist_ok=True)
        pq.write_table(pa.table(columns), tmp_path / day / f"{name}.parquet")

    base = scratch()
    put("1", "a", id=[1])
    put("1", "b", id=[1])
    good(shared_landing.run(spark, str(tmp_path), schema, base))
    put("2", "a", id=["text"])
    put("2", "b", id=[2])
    for _ in range(2):
        outcomes = shared_landing.run(spark, str(tmp_path), schema, base)
        assert "column types" in str(outcomes["a"]) and outcomes["b"] is None
        assert spark.table(f"{schema}.b_bronze").count() == 2
    register = shared_landing.register_of(spark, str(tmp_path), schema)
    assert {name for _, name in register.unfinished()} == {"a"}
    put("2", "a", id=[7])  # the file is put right
    good(shared_landing.run(spark, str(tmp_path), schema, base))
    assert sorted(r.id for r in spark.table(f"{schema}.a_bronze").collect()) == [1, 7]


def test_missing_files_by_register(spark, config):
    land(spark, [("I", 1)], "Op string, id int", f"{config.folder}/t/1")
    good(change_bronze.run(spark, config))
    land(spark, [("I", 2)], "Op string, id int", f"{config.folder}/t/2")
    register = FileRegister.beside(spark, config.layout("t").bronze)
    missing = missing_files(list_files(spark, config.folder, "*.parquet"), register.taken(), file_column="file_path")
    assert ["/t/2/" in r.file_path for r in missing.collect()] == [True]


def _csv(folder, number, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"f{number}.csv").write_text("id\n" + "".join(f"{r}\n" for r in rows))


def test_batch_loads_by_register(spark, schema, tmp_path, monkeypatch):
    files = {"filenames": [{"name": "f*.csv", "table": "t"}]}
    load = lambda **more: batch_files.run(spark, DomainConfig.from_dict(str(tmp_path), schema, files, **more))
    ids = lambda: sorted(r.id for r in spark.table(f"{schema}.t").collect())
    _csv(tmp_path, 1, [1])
    assert load(skip_seen=True) and load(skip_seen=True) == {} and ids() == [1]
    _csv(tmp_path, 2, [2])
    with monkeypatch.context() as patch:  # a crash after the rows are in
        patch.setattr(FileRegister, "finish", lambda *_: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            load(skip_seen=True)
    assert load(skip_seen=True) == {} and ids() == [1, 2]
    _csv(tmp_path, 3, [3])
    with monkeypatch.context() as patch:  # a crash before
        patch.setattr(batch_files, "append_table", lambda *_: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            load(skip_seen=True)
    assert load(skip_seen=True) and ids() == [1, 2, 3]
    assert load(mode="overwrite") and ids() == [1, 2, 3]
    load()  # without skip_seen files come again
    assert ids() == [1, 1, 2, 2, 3, 3] and load(skip_seen=True) == {}


def test_a_table_without_register_gets_one(spark, schema, tmp_path):
    from siltworks.functions import with_lineage

    _csv(tmp_path, 1, [1])
    rows = with_lineage(spark.read.csv(str(tmp_path), header=True, inferSchema=True), source_file="_source_file")
    rows.write.saveAsTable(f"{schema}.t")
    _csv(tmp_path, 2, [2])
    files = {"filenames": [{"name": "f*.csv", "table": "t"}]}
    batch_files.run(spark, DomainConfig.from_dict(str(tmp_path), schema, files, skip_seen=True))
    assert sorted(r.id for r in spark.table(f"{schema}.t").collect()) == [1, 2]


def test_registers_with_nothing_in_them(spark, scratch):
    register = FileRegister(spark, scratch("register"))
    assert not register.exists() and register.unfinished() == [] and register.schemas() == {}
    assert register.taken().count() == 0 and not register.is_planned("x")
    register.plan("x", spark.createDataFrame([], "path string, file_path string"))
    assert register.exists() and register.names("x") == [] and register.unfinished() == []
    taken = Intake(spark, register, lambda _: Target("none", lambda rows: rows), Reading())
    taken.open_batches()
    assert taken.errors == {} and registers.without(register.planned(), register.done().withColumn("file_path", F.lit(""))).count() == 0
