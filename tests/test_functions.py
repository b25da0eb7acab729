from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from siltworks.functions import (Bound, from_epoch_or_text, guarded_ratio, has_text, steady_round,
                                 tier, to_moment, typed, with_lineage)
from siltworks.plans.air_quality import humidity_index, pm25_category
from siltworks.plans.teams import offensive_tier


def labels(spark, column, kind, values):
    df = spark.createDataFrame([(i, kind, v) for i, v in enumerate(values)],
                               "n int, pollutant string, v double")
    return [r[0] for r in df.select(column.alias("label"), "n").orderBy("n").collect()]


def test_pm25_bounds(spark):
    values = [0.0, 12.0, 12.01, 35.4, 35.5, 55.4, 55.5, 150.4, 150.5, None]
    assert labels(spark, pm25_category("v"), "pm25", values) == [
        "Good", "Good", "Moderate", "Moderate", *["Unhealthy for Sensitive Groups"] * 2,
        "Unhealthy", "Unhealthy", "Very Unhealthy", "Very Unhealthy"]
    assert labels(spark, pm25_category("v"), "no2", [1.0]) == [None]


def test_humidity_first_bound_is_strict(spark):
    values = [59.9, 60.0, 70.0, 70.1, 75.0, 75.1, None]
    assert labels(spark, humidity_index("v"), "relativehumidity", values) == [
        "Low", "Medium", "Medium", "High", "High", "Very High", "Very High"]
    assert labels(spark, humidity_index("v"), "pm25", [1.0]) == [None]


def test_offensive_tiers_descend(spark):
    values = [2.0, 1.99, 1.5, 1.0, 0.99, None]
    assert labels(spark, offensive_tier("v"), "x", values) == [
        "elite", "strong", "strong", "average", "developing", "developing"]


def test_null_label(spark):
    column = tier("v", [Bound("<", 1.0, "low")], "high", label_nulls=True)
    assert labels(spark, column, "x", [0.0, None, 2.0]) == ["low", None, "high"]


def test_unknown_pollutant_skips_to_bounds(spark):
    df = spark.createDataFrame([(None, 10.0)], "pollutant string, daily_avg double")
    assert df.select(pm25_category()).first()[0] == "Good"


def test_guarded_ratio_and_text(spark):
    df = spark.createDataFrame([(1, 2, " a "), (1, 0, ""), (1, -1, None), (1, None, "  ")],
                               "n int, d int, t string")
    rows = df.select(guarded_ratio("n", "d"), has_text(F.trim("t"))).collect()
    assert [tuple(r) for r in rows] == [(0.5, True), (None, False), (None, False), (None, False)]


def test_typed_is_tolerant_unless_strict(spark):
    df = spark.createDataFrame([("12",), ("x",)], "v string")
    assert [r[0] for r in df.select(typed("v", "int")).collect()] == [12, None]
    try:
        df.select(typed("v", "int", strict=True)).collect()
    except Exception as error:
        assert "CAST_INVALID_INPUT" in str(error)
    else:
        raise AssertionError("a strict cast must fail on text")


def test_moments(spark):
    df = spark.createDataFrame([("2024-01-01T23:00:00-05:00", "2024-07-01 10:00:00", "1704067200")],
                               "offset string, local string, epoch string")
    row = df.select(F.to_date(to_moment("offset")).cast("string"),
                    to_moment("local", zone="America/New_York").cast("string"),
                    from_epoch_or_text("epoch", True).cast("string"),
                    from_epoch_or_text("local", False).cast("string")).first()
    assert tuple(row) == ("2024-01-02", "2024-07-01 14:00:00", "2024-01-01 00:00:00",
                          "2024-07-01 10:00:00")


def test_steady_round_ignores_last_bits(spark):
    df = spark.createDataFrame([(38.37875,), (38.378749999999997,), (-0.00005,)], "v double")
    assert [r[0] for r in df.select(steady_round("v", 4)).collect()] == [38.3788, 38.3788, -0.0001]


def test_lineage(spark, scratch):
    path = scratch()
    spark.range(2).write.parquet(path)
    moment = dt.datetime(2024, 1, 2, 3, 4, tzinfo=dt.timezone.utc)
    df = with_lineage(spark.read.parquet(path), "_at", "_day", "_file", tags={"_table": "db.t"}, now=moment)
    row = df.first()
    assert row._day == dt.date(2024, 1, 2) and row._table == "db.t"
    assert row._file.endswith(".parquet") and path.split("/")[-1] in row._file
    assert df.columns == ["id", "_at", "_day", "_file", "_table"]


def test_task_functions_need_no_installed_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from siltworks.sources.archives import _members
    from siltworks.sources.files import arrow_location

    (tmp_path / "functions.bin").write_bytes(cloudpickle.dumps([_members, arrow_location]))
    done = subprocess.run([sys.executable, "-I", "-c", "import pickle; print(pickle.load(open('functions.bin', 'rb')))"],
                          cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.returncode == 0, done.stderr
