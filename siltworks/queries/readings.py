"""Sensor readings made from the whole ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import keep_members
from ..operators.moments import Moments
from ..operators.summarize import spread_summary
from ..plans import air_quality
from ..session import scratch_path
from .base import Query, fresh_schema, plain, read, rounded, text

_EXPECTED_RAW = """
  SELECT event_id,
         user_id % 25 AS location_id,
         date_trunc('hour', ts) AS measured_at,
         CASE WHEN event_type = 'error' THEN -value
              WHEN event_type = 'signup' AND value < 5 THEN NULL
              ELSE value END AS value,
         CASE event_type WHEN 'view' THEN 'pm25' WHEN 'click' THEN 'relativehumidity'
                         ELSE event_type END AS pollutant,
         CASE event_type WHEN 'click' THEN '%' ELSE 'ug/m3' END AS unit
  FROM events"""

_EXPECTED_SILVER = f"""
  SELECT location_id, pollutant, unit, measured_at, value, event_id,
         'Loc ' || location_id AS location_name,
         location_id / 2e0 AS latitude, -location_id / 4e0 AS longitude,
         CAST(CAST(measured_at AS DATE) AS VARCHAR) AS measured_date,
         CAST(year(measured_at) AS INTEGER) AS measured_year,
         CAST(month(measured_at) AS INTEGER) AS measured_month
  FROM ({_EXPECTED_RAW})
  WHERE value >= 0
  QUALIFY row_number() OVER (PARTITION BY location_id, pollutant, measured_at
                             ORDER BY event_id) = 1"""

_EXPECTED_GOLD = f"""
  SELECT *,
    CASE WHEN pollutant <> 'pm25' THEN NULL WHEN daily_avg <= 12.0 THEN 'Good'
         WHEN daily_avg <= 35.4 THEN 'Moderate'
         WHEN daily_avg <= 55.4 THEN 'Unhealthy for Sensitive Groups'
         WHEN daily_avg <= 150.4 THEN 'Unhealthy' ELSE 'Very Unhealthy' END AS pm25_aqi_category,
    CASE WHEN pollutant <> 'relativehumidity' THEN NULL WHEN daily_max < 60.0 THEN 'Low'
         WHEN daily_max <= 70.0 THEN 'Medium' WHEN daily_max <= 75.0 THEN 'High'
         ELSE 'Very High' END AS rel_humidity_index
  FROM (
    SELECT location_id, location_name, pollutant, unit, latitude, longitude, measured_date,
           measured_year, measured_month,
           {rounded('avg(value)', 4)} AS daily_avg, {rounded('max(value)', 4)} AS daily_max,
           {rounded('min(value)', 4)} AS daily_min, {rounded('stddev_samp(value)', 4)} AS daily_stddev,
           count(value) AS reading_count
    FROM ({_EXPECTED_SILVER})
    GROUP BY ALL)"""


def landed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of landed sensor files: text values, some unusable."""
    events = read(spark, sf_dir, "events")
    location = F.col("user_id") % 25
    kind = F.col("event_type")
    value = (F.when(kind == "error", F.concat(F.lit("-"), F.col("value").cast("string")))
             .when((kind == "signup") & (F.col("value") < 5), F.lit("n/a"))
             .otherwise(F.col("value").cast("string")))
    return events.select(
        "event_id", location.alias("location_id"), location.alias("locationid"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        value.alias("value"),
        F.when(kind == "view", "pm25").when(kind == "click", "relativehumidity")
        .otherwise(kind).alias("parameter"),
        F.when(kind == "click", "%").otherwise("ug/m3").alias("units"),
        F.concat(F.lit("Loc "), location).alias("location"),
        (location / F.lit(2.0)).alias("lat"), (-location / F.lit(4.0)).alias("lon"))


def silver_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = air_quality.silver(landed_readings(spark, sf_dir), prefer=["event_id"])
    return clean.withColumns({"measured_at": plain("measured_at"),
                              "measured_date": text("measured_date")})


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = air_quality.silver(landed_readings(spark, sf_dir), prefer=["event_id"])
    return air_quality.gold(clean).withColumn("measured_date", text("measured_date"))


def air_quality_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed CSV files by location and year -> stream -> three tables."""
    landed = landed_readings(spark, sf_dir).withColumn("year", F.year("datetime"))
    root = scratch_path(spark, "readings")
    landed.write.partitionBy("locationid", "year").option("header", "true").option(
        "compression", "gzip").csv(root)
    schema = T.StructType([f for f in landed.schema.fields if f.name not in ("locationid", "year")]
                          + [T.StructField("locationid", T.LongType()),
                             T.StructField("year", T.IntegerType())])
    # Few rows each: one per location, one per year.
    ids = [r.locationid for r in landed.select("locationid").distinct().toLocalIterator()]
    years = [r.year for r in landed.select("year").distinct().toLocalIterator()]
    tables = fresh_schema(spark)
    air_quality.run(spark, root, schema, tables, scratch_path(spark, "checkpoint"), ids, years,
                    prefer=["event_id"])
    return spark.table(f"{tables}.gold_readings_daily").withColumn(
        "measured_date", text("measured_date"))


def air_quality_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings land in two waves, the second with late and corrected ones; only the months that it touches
    are made anew."""
    landed = landed_readings(spark, sf_dir).withColumn("year", F.year("datetime"))
    root, late = scratch_path(spark, "readings"), F.col("event_id") % 3 == 0
    wrong = (F.col("event_id") % 7 == 1) & F.col("value").try_cast("double").between(0, 1e9) & ~late
    first = landed.where(~late).withColumns({"value": F.when(wrong, F.lit("1.5")).otherwise(F.col("value")), "revision": F.lit(0)})
    second = landed.where(late | wrong).withColumn("revision", F.lit(1))
    csv = [f for f in first.schema.fields if f.name not in ("locationid", "year")]
    schema = T.StructType(csv + [T.StructField("locationid", T.LongType()), T.StructField("year", T.IntegerType())])
    ids = [r.locationid for r in landed.select("locationid").distinct().toLocalIterator()]  # one row each
    years = [r.year for r in landed.select("year").distinct().toLocalIterator()]
    tables, checkpoint = fresh_schema(spark), scratch_path(spark, "checkpoint")
    for wave in (first, second):
        wave.write.mode("append").partitionBy("locationid", "year").option("header", "true").csv(root)
        air_quality.run_incremental(spark, root, schema, tables, checkpoint, ids, years,
                                    prefer=["event_id", F.col("revision").desc()])
    return spark.table(f"{tables}.gold_readings_daily").withColumn("measured_date", text("measured_date"))


def moments_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistics of events from partial summaries of three batches in odd order, one entered twice
    and two compacted."""
    events = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts").cast("string"))
    moments = Moments(f"{fresh_schema(spark)}.event_moments", ["event_type", "day"], "value")
    for batch in (2, 0, 1, 0):
        moments.add(events.where(F.col("event_id") % 3 == batch), batch)
    moments.compact(spark, 1)
    return moments.summary(spark)


def event_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts").cast("string"))
    return spread_summary(events, ["event_type", "day"], "value")


def member_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal list as IN predicate, a table of members as semi join."""
    wanted = keep_members(read(spark, sf_dir, "customer"), "c_mktsegment",
                          ["BUILDING", "MACHINERY"])
    return keep_members(wanted, "c_custkey", read(spark, sf_dir, "orders").select("o_custkey"))


_SPREAD = f"""
        SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
               {rounded('avg(value)', 4)} AS daily_avg, {rounded('max(value)', 4)} AS daily_max,
               {rounded('min(value)', 4)} AS daily_min, {rounded('stddev_samp(value)', 4)} AS daily_stddev,
               count(value) AS reading_count
        FROM events GROUP BY ALL"""

QUERIES = {
    "daily_summary": Query(daily_summary, _EXPECTED_GOLD),
    "silver_readings": Query(silver_readings, _EXPECTED_SILVER),
    "air_quality_medallion": Query(air_quality_medallion, _EXPECTED_GOLD),
    "air_quality_refresh": Query(air_quality_refresh, _EXPECTED_GOLD),
    "moments_merged": Query(moments_merged, _SPREAD),
    "event_spread": Query(event_spread, _SPREAD),
    "member_filter": Query(member_filter, """
        SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
          AND c_custkey IN (SELECT o_custkey FROM orders)"""),
}
