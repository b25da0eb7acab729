from __future__ import annotations

import datetime as dt
import uuid

import pytest

from siltworks.session import build_session, scratch_path
from siltworks.sinks.tables import ensure_schema


@pytest.fixture(scope="session")
def spark():
    session = build_session("siltworks-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    """Makes unused paths in the shared scratch folder."""
    return lambda label="test": scratch_path(spark, label)


@pytest.fixture
def schema(spark):
    name = f"test_{uuid.uuid4().hex[:12]}"
    ensure_schema(spark, name, scratch_path(spark, name))
    return name


@pytest.fixture
def now():
    return dt.datetime(2024, 2, 1, 12, 0, tzinfo=dt.timezone.utc)
