"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from siltworks.queries import registry
from siltworks.queries.landing import TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _key(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "NULL"
    if isinstance(value, float):
        return f"{value:.9g}"
    return f"{type(value).__name__}:{value}"


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def difference(spark, connection, name: str, sf_dir: str = SF_DIR) -> str | None:
    """What differs between the two results of a query, or None."""
    query = registry()[name]
    df = query.run(spark, sf_dir)
    ours = _sorted(df.columns, df.collect())
    cursor = connection.execute(query.sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    theirs = _sorted(columns, cursor.fetchall())
    if ours == theirs:
        return None
    only_ours = [r for r in ours if r not in set(theirs)][:3]
    only_theirs = [r for r in theirs if r not in set(ours)][:3]
    return f"{len(ours)} rows against {len(theirs)}; {sorted(columns)}; {only_ours} against {only_theirs}"


if __name__ == "__main__":
    from siltworks.session import build_session

    session = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                  "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    database, bad = connect(), 0
    for query_name in sys.argv[1:] or registry():
        started = time.time()
        try:
            problem = difference(session, database, query_name)
        except Exception as error:  # show every failing query, not just the first
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.time() - started:6.1f}s {query_name}: {problem or 'ok'}", flush=True)
    sys.exit(bool(bad))
