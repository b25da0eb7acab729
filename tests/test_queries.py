"""Every registered query against its SQL on an independent engine."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points
from siltworks.queries import registry

from .oracle import SF_DIR, connect, difference


@pytest.fixture(scope="module")
def database():
    return connect()


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_sql(spark, database, name):
    assert difference(spark, database, name, SF_DIR) is None


def test_every_query_has_sql():
    assert all(query.sql for query in registry().values())
    assert set(registry()) <= set(entry_points.queries())


def test_names_are_plain():
    assert all(re.fullmatch(r"[a-z][a-z_]+", n) and not n.startswith("op")
               for n in registry())


def test_entry_has_rows_and_schema(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0
    assert {"daily_avg", "pm25_aqi_category", "rel_humidity_index"} <= set(df.columns)
