"""CSV records whose fields don't match the header: nothing that was written is lost."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from siltworks.config import Reading
from siltworks.operators.rescue import RECORD
from siltworks.plans import shared_landing
from siltworks.streaming.rescue import files_by_types


@pytest.fixture
def take_in(spark, scratch, schema, tmp_path):
    base = scratch()

    def run(text, day="1", **options):
        (tmp_path / day).mkdir()
        (tmp_path / day / "t.csv").write_bytes(text.encode())
        outcomes = shared_landing.run(spark, str(tmp_path), schema, base, Reading("csv", options))
        assert outcomes["t"] is None, outcomes
        rows = spark.table(f"{schema}.t_bronze").where(F.col("_source_file").contains(f"/{day}/t.csv"))
        return [tuple(r) for r in rows.drop("_ingest_ts", "_source_file", "_source_name").orderBy("id").collect()]

    return run


def test_surplus_and_missing_fields(take_in):
    found = take_in("id,qty\n1,5\n2,6,SURPLUS\n3\n4,\n\n5,7,,\n")
    assert [r[:2] for r in found] == [(1, 5), (2, 6), (3, None), (4, None), (5, 7)]
    assert [r[2] and json.loads(r[2])[RECORD] for r in found] == [None, "2,6,SURPLUS", "3", None, "5,7,,"]


def test_a_misfit_and_a_surplus_field_of_one_record(take_in):
    take_in("id,qty\n1,5\n")
    found = take_in("id,qty\n2,six,x\n3,7\n", "2")
    assert found[0][:2] == (2, None) and json.loads(found[0][2]) == {"qty": "six", RECORD: "2,six,x"}
    assert found[1] == (3, 7, None)


def test_quoted_line_breaks(take_in):
    found = take_in('id,note\n1,"one\ntwo"\n2,"a ""b"" c"\n3,x,y\n4,"p\r\n\nq"\n')
    assert [r[1] for r in found][0] == "one\ntwo" and [r[1] for r in found][3].replace("\r", "") == "p\n\nq"
    assert [r[0] for r in found] == [1, 2, 3, 4]
    assert json.loads(found[2][2]) == {RECORD: "3,x,y"}


def test_an_escaped_quote_before_a_line_break(take_in):
    found = take_in('id,note\n1,"a\\"\nb"\n2,z\n')
    assert [(r[0], r[1]) for r in found] == [(1, 'a"\nb'), (2, "z")]


def test_a_quote_that_is_never_closed(take_in):
    found = take_in('id,note,last\n1,a,b\n2,"open,c\n3,d,e\n')
    kept = json.dumps(found)
    assert all(piece in kept for piece in ("open", "3", "d", "e", "c"))


def test_other_separators_and_quotes(take_in):
    found = take_in("id;note\n1;'a;b'\n2;c;d\n", sep=";", quote="'")
    assert found[0][:2] == (1, "a;b") and json.loads(found[1][2]) == {RECORD: "2;c;d"}


def test_only_files_that_need_it_are_read_whole(spark, tmp_path):
    (tmp_path / "even.csv").write_text('id,note\n1,"a"\n2,""\n')
    (tmp_path / "odd.csv").write_text('id,note\n1,"a\nb"\n')
    files = spark.createDataFrame([(f"file:{tmp_path}/{n}.csv",) for n in ("even", "odd")], "path string")
    assert {(paths[0].rsplit("/", 1)[-1], over) for paths, over in files_by_types(files, Reading("csv"))} == {("even.csv", False), ("odd.csv", True)}
    fixed = Reading("csv", {"multiLine": "false"})
    assert {over for _, over in files_by_types(files, fixed)} == {False}
