from __future__ import annotations

import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.config import ColumnSpec, DomainConfig, TableSpec
from siltworks.operators.conform import find_date_column, resolve_column, resolve_synonyms
from siltworks.operators.rescue import rescue_types
from siltworks.plans import batch_files
from siltworks.session import checkpoint_root, scratch_path
from siltworks.sinks.tables import (append_table, create_table, describe_table, ensure_schema,
                                    preview, replace_table, write_table)
from siltworks.sources.archives import archive_lines, archive_members, extract_members
from siltworks.sources.discovery import tables_by_folder, tables_by_stem, tables_by_suffix
from siltworks.sources.files import (arrow_location, configured_table, format_of, list_files,
                                     matching_files, partition_glob, read_configured, read_files,
                                     read_matching, read_partitions, years_since)
from siltworks.sources.jdbc import Connection, split_options

from .plans import plan_text


@pytest.mark.parametrize("name, expected", [
    ("sales.json", "json"), ("sales.CSV", "csv"), ("sales.parquet", "parquet"), ("sales.pqt", "parquet"),
    ("a.avro", "avro"), ("a.txt", "text"), ("a.text", "text"), ("a.orc", "orc"), ("a.xml", "xml"),
    ("sales.bin", "binaryFile"), ("noext", "binaryFile"), ("x.csv.gz", "csv"), ("d.x/y.json", "json"),
    ("x.gz", "binaryFile"), ("*.csv", "csv")])
def test_format_of(name, expected):
    assert format_of(name) == expected


def test_partition_globs():
    assert partition_glob("/r/", locationid=[1, 2], year=range(2023, 2025)) == "/r/locationid={1,2}/year={2023,2024}"
    assert list(years_since(2023, dt.date(2025, 5, 1))) == [2023, 2024, 2025]


@pytest.fixture
def tree(tmp_path):
    (tmp_path / "nested" / "deep").mkdir(parents=True)
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "nested" / "two.csv").write_text("a,b\n3,x\n")
    (tmp_path / "nested" / "deep" / "one.csv").write_text("a,b\n5,6\n")
    (tmp_path / "nested" / "deep" / "data.json").write_text('{"a": 1}\n')
    return tmp_path



def test_matching_files(spark, tree):
    names = lambda pattern: [p.split(tree.name + "/")[1] for p in matching_files(spark, str(tree), pattern)]
    assert names("*.csv") == ["nested/deep/one.csv", "nested/two.csv", "one.csv"]
    assert names("one.csv") == ["nested/deep/one.csv"]
    assert names("nested/*.csv") == ["nested/two.csv"]
    assert names("deep/one.csv") == ["nested/deep/one.csv"]
    assert names("nes*/t?o.csv") == ["nested/two.csv"]
    assert names("missing.csv") == []
    assert matching_files(spark, str(tree / "absent"), "*.csv") == []


def test_listing_never_reads_content(spark, tree):
    plan = plan_text(list_files(spark, str(tree), "*.csv"))
    assert "content" not in plan.split("ReadSchema:")[1]


def test_read_matching(spark, tree):
    got = read_matching(spark, str(tree), "*.csv")
    assert sorted((r.a, r.b) for r in got.collect()) == [(1, "2"), (3, "x"), (5, "6")]
    assert read_matching(spark, str(tree), "nested/deep/*.json").first().a == 1
    assert read_matching(spark, str(tree), "none*.csv") is None
    assert read_matching(spark, str(tree / "absent"), "*.csv") is None


def test_xml_needs_row_tag_and_reads(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<rows><row><a>1</a></row><row><a>2</a></row></rows>")
    with pytest.raises(ValueError, match="rowTag"):
        read_files(spark, str(tmp_path), "xml")
    assert read_files(spark, str(tmp_path), "xml", options={"rowTag": "row"}).count() == 2


def test_unknown_extension_is_binary(spark, tmp_path):
    (tmp_path / "sales.bin").write_bytes(b"\x00\x01")
    assert bytes(read_matching(spark, str(tmp_path), "sales.bin").first().content) == b"\x00\x01"


def test_avro_without_package_says_so(spark, tmp_path):
    (tmp_path / "a.avro").write_bytes(b"Obj")
    with pytest.raises(ValueError, match="spark-avro"):
        read_files(spark, str(tmp_path / "a.avro"), "avro")


def test_partition_columns_prune_folders(spark, scratch):
    root = scratch()
    spark.range(10).withColumn("p", F.col("id") % 5).write.partitionBy("p").parquet(root)
    df = read_partitions(spark, root, "parquet", p=[1, 2])
    assert df.count() == 4
    assert "PartitionFilters: [p" in plan_text(df) and len(df.inputFiles()) <= 8 * 2


def test_configured_table(spark, schema):
    spark.range(3).write.saveAsTable(f"{schema}.teams_bronze")
    assert configured_table(spark, "bronze", table="t") == "spark_catalog.default.t"
    spark.conf.set("bronze_schema", schema)
    try:
        assert configured_table(spark, "bronze", table="t") == f"spark_catalog.{schema}.t"
        assert read_configured(spark, "bronze", table="teams_bronze").count() == 3
    finally:
        spark.conf.unset("bronze_schema")


def test_discovery(spark, tmp_path, schema):
    for name in ("orders", "employees"):
        (tmp_path / name).mkdir()
    (tmp_path / "_manifest.json").write_text("{}")
    assert tables_by_folder(spark, str(tmp_path)) == ["employees", "orders"]
    assert tables_by_folder(spark, str(tmp_path / "absent")) == []
    for day, name in (("d1", "orders"), ("d2", "orders"), ("d2", "people")):
        (tmp_path / day).mkdir(exist_ok=True)
        (tmp_path / day / f"{name}.parquet").write_bytes(b"not read")
    assert tables_by_stem(spark, str(tmp_path), "parquet") == ["orders", "people"]
    assert tables_by_stem(spark, str(tmp_path / "absent"), "parquet") == []
    for table in ("b_bronze", "a_bronze", "a_silver"):
        spark.range(1).write.saveAsTable(f"{schema}.{table}")
    assert tables_by_suffix(spark, schema) == ["a_bronze", "b_bronze"]



def test_discovery_of_tables_that_are_folders_of_part_files(spark, tmp_path):
    root = tmp_path / "above.parquet"  # a folder above the root's files names no table
    for name in ("orders.parquet/part-0000.parquet", "orders.parquet/part-0001.parquet", "people.parquet",
                 "d1/sales.parquet/year=2024/part-0.snappy.parquet", "d2.csv/stock.parquet"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"not read")
    assert tables_by_stem(spark, str(root), "parquet") == ["orders", "people", "sales", "stock"]


def test_arrow_locations(tmp_path):
    for uri in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        assert arrow_location(uri)[1] == str(tmp_path)


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("example.txt", "hello from zip")
        archive.writestr("sub/two.txt", "one\ntwo\r\nthree\n")
    (tmp_path / "not.txt").write_text("x")
    members = {r.entry: bytes(r.content) for r in archive_members(spark, str(tmp_path)).collect()}
    assert members["example.txt"] == b"hello from zip" and set(members) == {"example.txt", "sub/two.txt"}
    lines = [(r.line_no, r.line) for r in archive_lines(spark, str(tmp_path)).where("entry LIKE 'sub%'").collect()]
    assert sorted(lines) == [(0, "one"), (1, "two"), (2, "three")]
    landing = tmp_path / "landing"
    written = extract_members(spark, str(tmp_path), landing.as_uri()).collect()
    assert (landing / "sub" / "two.txt").read_bytes() == b"one\ntwo\r\nthree\n"
    assert sorted(r.bytes for r in written) == [14, 15]
    assert sorted(p.name for p in landing.rglob("*") if p.is_file()) == ["example.txt", "two.txt"]


def test_members_of_one_name_stay_apart(spark, tmp_path):
    texts = {"a.zip": "one", "b.zip": "two", "sub/b.zip": "three"}
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name, text in texts.items():
        with zipfile.ZipFile(tmp_path / "in" / name, "w") as archive:
            archive.writestr("data.csv", text)
            archive.writestr(f"only-{text}.csv", text)
    rows = extract_members(spark, str(tmp_path / "in"), (tmp_path / "landing").as_uri()).collect()
    files = {str(p.relative_to(tmp_path / "landing")): p.read_text() for p in (tmp_path / "landing").rglob("*.csv")}
    assert len(rows) == len({r.written_to for r in rows}) == 6
    assert files == {"data.csv": "one", "b.zip/data.csv": "two", "sub/b.zip/data.csv": "three",
                     **{f"only-{text}.csv": text for text in texts.values()}}


def test_archive_must_not_write_outside(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("../evil.txt", "x")
    with pytest.raises(Exception, match="outside its archive"):
        extract_members(spark, str(tmp_path), (tmp_path / "landing").as_uri()).collect()


def test_database_urls_and_splits():
    connection = Connection("mysql", "db.example", "reader", "secret")
    assert connection.url("shop") == "jdbc:mysql://db.example:3306/shop"
    assert "secret" not in repr(connection)
    assert Connection("postgresql", "h", "u", "p", 6000).url("d") == "jdbc:postgresql://h:6000/d"
    assert Connection("sqlserver", "h", "u", "p").url("d") == "jdbc:sqlserver://h:1433;databaseName=d"
    with pytest.raises(ValueError, match="unknown database type"):
        Connection("none", "h", "u", "p").url("d")
    assert split_options("id", 1, 100, 4) == {"partitionColumn": "id", "lowerBound": "1",
                                              "upperBound": "100", "numPartitions": "4"}
    assert split_options(None, 1, 2, 3) == {}


def test_batch_domain_appends_and_skips_seen(spark, tree, schema):
    files = '{"filenames": [{"name": "*.csv", "table": "all_bronze"}, {"name": "missing.csv", "table": "none"}]}'
    load = lambda skip: batch_files.run(spark, DomainConfig.from_dict(str(tree), schema, files, skip_seen=skip))
    assert load(True) == {"*.csv": f"{schema}.all_bronze"}
    table = f"{schema}.all_bronze"
    assert {"_ingest_timestamp", "_source_file"} <= set(spark.table(table).columns)
    assert load(True) == {} and spark.table(table).count() == 3
    (tree / "three.csv").write_text("a,b,c\n7,8,9\n")
    load(True)
    assert spark.table(table).count() == 4 and spark.table(table).where("c = 9").count() == 1
    load(False)
    assert spark.table(table).count() == 8
    with pytest.raises(ValueError, match="mode"):
        batch_files.run(spark, DomainConfig.from_dict(str(tree), schema, files, mode="merge"))


def test_append_widens_and_replace_drops(spark, schema):
    table = f"{schema}.t"
    append_table(spark.createDataFrame([(1, "a")], "id int, x string"), table)
    append_table(spark.createDataFrame([("b", 2.5, 2)], "X string, y double, id long"), table)
    assert sorted((tuple(r) for r in spark.table(table).collect()), key=str) == [(1, "a", None), (2, "b", 2.5)]
    write_table(spark.createDataFrame([(9,)], "z int"), table, "overwrite")
    assert spark.table(table).columns == ["z"] and spark.table(table).count() == 1


def test_partitioned_replace_and_append(spark, schema):
    table = f"{schema}.p"
    replace_table(spark.range(10).withColumn("p", F.col("id") % 2), table, ["p"])
    append_table(spark.createDataFrame([(1, 77)], "p long, id long"), table, ["p"])
    assert sorted(r.id for r in spark.table(table).where("p = 1").collect()) == [1, 3, 5, 7, 9, 77]
    assert "PartitionFilters: [isnotnull(p" in plan_text(spark.table(table).where("p = 1"))


def test_table_from_spec(spark, schema):
    spec = TableSpec(f"{schema}.users", [
        ColumnSpec("user_id", "STRING", "Unique id, it's"), ColumnSpec("email", "STRING"),
        ColumnSpec("signup_timestamp", "TIMESTAMP")], "All users", {"quality": "silver"})
    create_table(spark, spec)
    create_table(spark, spec)
    assert spark.table(spec.name).dtypes == [("user_id", "string"), ("email", "string"), ("signup_timestamp", "timestamp")]
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {spec.name}").collect()}
    assert described["user_id"] == "Unique id, it's"
    describe_table(spark, spec.name, "Other")
    ensure_schema(spark, schema)
    assert preview(spark.range(10)).count() == 5


def test_rescue(spark):
    raw = spark.createDataFrame([("1", "2.5", None, "f1"), ("x", "y", "new", "f2"), (None, "1", None, "f3")],
                                "id string, v string, extra string, _source_file string")
    wanted = T.StructType().add("id", T.IntegerType()).add("v", T.DoubleType())
    got = rescue_types(raw, wanted).orderBy("_source_file").collect()
    assert [tuple(r) for r in got] == [(1, 2.5, "f1", None),
                                       (None, None, "f2", '{"id":"x","v":"y","extra":"new"}'), (None, 1.0, "f3", None)]


def test_column_names():
    assert resolve_column(["Temp C", "a"], ["temp_c"]) == "Temp C"
    assert resolve_column(["temperature_celsius"], ["temperature"]) is None
    assert resolve_synonyms(["LAT", "x"], {"latitude": ["lat"], "longitude": ["lon"]}) == {"latitude": "LAT"}
    assert find_date_column(["_date", "x", "Sample Time", "date"]) == "Sample Time"
    assert find_date_column(["updated_at", "ingestion_date"], {"ingestiondate"}) is None


def test_scratch_is_below_the_session_setting(spark):
    assert scratch_path(spark, "x").startswith(checkpoint_root(spark) + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
