"""Table writing, schema changes and simple reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ColumnSpec, TableSpec
from ..operators.clean import cast_columns, drop_repeats, first_per_key
from ..operators.rescue import RESCUED, rescue_types
from ..session import scratch_path
from ..sinks.tables import append_table, create_table, preview, replace_table
from ..sources.files import read_files
from .base import Query, fresh_schema, nullable, read

CUSTOMER_SPEC = [
    ColumnSpec("c_custkey", "BIGINT", "Customer's number"), ColumnSpec("c_name", "STRING", "Name"),
    ColumnSpec("c_nationkey", "INT", "Nation"), ColumnSpec("c_acctbal", "DOUBLE", "Balance"),
    ColumnSpec("c_mktsegment", "STRING"),
]


def append_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, the second with one more column and without another."""
    customers = read(spark, sf_dir, "customer")
    table = f"{fresh_schema(spark)}.customer"
    append_table(customers.where("c_acctbal < 0").drop("c_mktsegment"), table)
    append_table(customers.where("c_acctbal >= 0").drop("c_nationkey"), table)
    return spark.table(table).withColumn("c_nationkey", nullable("c_nationkey"))


def partitioned_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by one with other columns, stored by year and month."""
    orders = read(spark, sf_dir, "orders")
    table = f"{fresh_schema(spark)}.orders"
    replace_table(orders.select("o_orderkey"), table)
    replace_table(orders.withColumns({"order_year": F.year("o_orderdate"),
                                      "order_month": F.month("o_orderdate")}),
                  table, ["order_year", "order_month"])
    return spark.table(table)


def table_from_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table created from a declaration, then filled."""
    table = f"{fresh_schema(spark)}.customer"
    create_table(spark, TableSpec(table, CUSTOMER_SPEC, "All customers", {"quality": "silver"}))
    append_table(read(spark, sf_dir, "customer"), table)
    return spark.table(table)


def rescued_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV values that do not fit their type, kept aside as JSON."""
    parts = read(spark, sf_dir, "part")
    landing = scratch_path(spark, "parts")
    odd = F.col("p_brand") == "Brand#7"
    parts.select("p_partkey", F.when(odd, F.concat(F.lit("x"), "p_size")).otherwise(
        F.col("p_size").cast("string")).alias("p_size"), "p_brand",
        F.when(F.col("p_type") == "ECONOMY", "new").alias("added")
    ).write.option("header", "true").csv(landing)
    raw = read_files(spark, landing, "csv", T.StructType(
        [T.StructField(c, T.StringType()) for c in ("p_partkey", "p_size", "p_brand", "added")]))
    wanted = T.StructType([T.StructField("p_partkey", T.LongType()),
                           T.StructField("p_size", T.IntegerType()),
                           T.StructField("p_brand", T.StringType())])
    return rescue_types(raw, wanted).select("p_partkey", nullable("p_size"), "p_brand",
                                            F.col(RESCUED).alias("rescued"))


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no JSON stay readable in a column of their own."""
    landing = scratch_path(spark, "lines")
    events = read(spark, sf_dir, "events")
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("broken "), "event_id")).otherwise(
        F.to_json(F.struct("event_id", "event_type")))
    events.select(line.alias("value")).write.text(landing)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("malformed", T.StringType())])
    lines = read_files(spark, landing, "json", schema, {"columnNameOfCorruptRecord": "malformed"})
    return lines.withColumn("event_id", nullable("event_id"))


def tolerant_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities such as ``5-LOW`` cast piecewise: text that is no number becomes NULL."""
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("level"),
        F.substring("o_orderpriority", 3, 20).alias("word"))
    typed = cast_columns(orders, {"level": "int", "word": "int", "not_there": "int"})
    return typed.withColumn("word", nullable("word"))


def first_event_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return first_per_key(events, ["user_id", "event_type", "hour"], ["event_id"]).select(
        "user_id", "event_type", "hour", "event_id", "value")


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplicated lines, any copy kept: only the key columns are comparable."""
    lines = read(spark, sf_dir, "lineitem")
    return drop_repeats(lines, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


def largest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return preview(orders.orderBy(F.desc("o_totalprice"), "o_orderkey"), 5)


def trimmed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar text and date functions over a whole table."""
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", F.trim(F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("priority"),
        F.length("o_orderpriority").alias("size"),
        F.regexp_extract("o_orderpriority", r"^(\d)-", 1).alias("level"),
        F.to_date("o_orderdate").cast("string").alias("day"), F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d"))


QUERIES = {
    "append_merge": Query(append_merge, """
        SELECT c_custkey, c_name, CAST(CASE WHEN c_acctbal < 0 THEN c_nationkey END AS DOUBLE) AS c_nationkey, c_acctbal,
               CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment FROM customer"""),
    "partitioned_overwrite": Query(partitioned_overwrite, """
        SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year,
               CAST(month(o_orderdate) AS INTEGER) AS order_month FROM orders"""),
    "table_from_spec": Query(table_from_spec, "SELECT * FROM customer"),
    "rescued_parts": Query(rescued_parts, """
        SELECT p_partkey, CAST(CASE WHEN p_brand <> 'Brand#7' THEN p_size END AS DOUBLE) AS p_size, p_brand,
               CASE WHEN p_brand = 'Brand#7' AND p_type = 'ECONOMY' THEN '{"p_size":"x' || p_size || '","added":"new"}'
                    WHEN p_brand = 'Brand#7' THEN '{"p_size":"x' || p_size || '"}'
                    WHEN p_type = 'ECONOMY' THEN '{"added":"new"}' END AS rescued FROM part"""),
    "malformed_lines": Query(malformed_lines, """
        SELECT CAST(CASE WHEN event_type <> 'error' THEN event_id END AS DOUBLE) AS event_id,
               CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
               CASE WHEN event_type = 'error' THEN 'broken ' || event_id END AS malformed FROM events"""),
    "tolerant_cast": Query(tolerant_cast, """
        SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
               CAST(TRY_CAST(substr(o_orderpriority, 3, 20) AS INTEGER) AS DOUBLE) AS word FROM orders"""),
    "first_event_per_hour": Query(first_event_per_hour, """
        SELECT user_id, event_type, date_trunc('hour', ts) AS hour, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts)
                                   ORDER BY event_id) = 1"""),
    "distinct_keys": Query(distinct_keys, "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem"),
    "largest_orders": Query(largest_orders, """
        SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5"""),
    "trimmed_text": Query(trimmed_text, r"""
        SELECT o_orderkey, o_orderpriority AS priority, CAST(length(o_orderpriority) AS INTEGER) AS size,
               regexp_extract(o_orderpriority, '^(\d)-', 1) AS level,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(year(o_orderdate) AS INTEGER) AS y,
               CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS d FROM orders"""),
}
