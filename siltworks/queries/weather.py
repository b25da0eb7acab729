"""Weather tables with unlike column names, made from the whole ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import steady_round
from ..operators.conform import select_synonyms
from ..plans import weather
from ..session import scratch_path
from ..sources.files import read_files
from .base import NOW, Query, fresh_schema, plain, read, rounded, text

_DAY_PARTS = """CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day"""

_EXPECTED_STATIONS = f"""
  SELECT event_type AS city, CASE WHEN user_id < 20 THEN NULL ELSE 'N' || user_id % 25 END AS country,
         value AS mean_temperature,
         CASE WHEN event_type = 'view' THEN NULL ELSE value / 2e0 END AS precipitation,
         date_trunc('second', ts) AS observation_timestamp, CAST(CAST(d AS DATE) AS VARCHAR) AS observation_date,
         {_DAY_PARTS}
  FROM (SELECT *, CAST(ts AS DATE) AS d FROM events)"""

_EXPECTED_DAILY = f"""
  SELECT country, city, observation_date, count(*) AS observation_count,
         {rounded('avg(mean_temperature)', 4)} AS avg_mean_temperature,
         {rounded('sum(precipitation)', 4)} AS total_precipitation
  FROM ({_EXPECTED_STATIONS}) GROUP BY ALL"""


def station_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with spaces and capitals, text numbers, text timestamps."""
    events = read(spark, sf_dir, "events")
    kind = F.col("event_type")
    return events.select(
        kind.alias("Location Name"),
        F.when(F.col("user_id") >= 20, F.concat(F.lit("N"), F.col("user_id") % 25)).alias("Country"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("last_updated"),
        F.col("value").cast("string").alias("Temp"),
        F.when(kind == "view", "none").otherwise((F.col("value") / F.lit(2.0)).cast("string"))
        .alias("rain_mm"),
        F.col("props").alias("remarks"))


def weather_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = weather.silver(station_text(spark, sf_dir))
    return clean.withColumns({"observation_timestamp": plain("observation_timestamp"),
                              "observation_date": text("observation_date")})


def weather_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch seconds, a place that may be missing: the row filter needs one of three places."""
    events = read(spark, sf_dir, "events")
    raw = events.select(
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("station_name"),
        F.when(F.col("value") > 10, F.concat(F.lit("N"), F.col("user_id"))).alias("nation"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("last_updated_epoch"),
        F.col("value").alias("wind kph"))
    clean = weather.silver(raw)
    return clean.withColumns({"observation_timestamp": plain("observation_timestamp"),
                              "observation_date": text("observation_date")})


def weather_ingest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No date column at all: the ingest day dates the row; no place column: no place filter."""
    raw = read(spark, sf_dir, "events").select(F.col("value").alias("humidity"),
                                               F.col("user_id").alias("lat"))
    return weather.silver(weather.bronze(raw, NOW)).withColumn("observation_date",
                                                               text("observation_date"))


def synonym_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").withColumnsRenamed({"o_orderkey": "Order-Key"})
    wanted = {"order_id": ["orderkey", "order_key"], "amount": ["total", "o_totalprice"],
              "status": ["O_ORDERSTATUS"], "absent": ["no_such_column"]}
    return select_synonyms(orders, wanted)


def _daily(observations: DataFrame) -> DataFrame:
    rounded = {c: steady_round(c, 4) for c in ("avg_mean_temperature", "total_precipitation")}
    return weather.gold(observations).withColumns(
        {**rounded, "observation_date": text("observation_date")})


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(weather.silver(station_text(spark, sf_dir)))


def weather_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed CSV dataset, its types inferred -> three tables."""
    tables, landing = fresh_schema(spark), scratch_path(spark, "dataset")
    named = station_text(spark, sf_dir).withColumnsRenamed({"Location Name": "location_name"})
    named.write.option("header", "true").csv(landing)
    weather.run(spark, read_files(spark, landing, "csv"), tables, NOW)
    rounded = {c: steady_round(c, 4) for c in ("avg_mean_temperature", "total_precipitation")}
    return spark.table(f"{tables}.gold_weather").withColumns(
        {**rounded, "observation_date": text("observation_date")})


QUERIES = {
    "weather_silver": Query(weather_silver, _EXPECTED_STATIONS),
    "weather_epoch": Query(weather_epoch, f"""
        SELECT CASE WHEN event_type <> 'error' THEN event_type END AS station,
               CASE WHEN value > 10 THEN 'N' || user_id END AS country,
               value AS wind_speed, date_trunc('second', ts) AS observation_timestamp,
               CAST(d AS VARCHAR) AS observation_date, {_DAY_PARTS}
        FROM (SELECT *, CAST(ts AS DATE) AS d FROM events)
        WHERE event_type <> 'error' OR value > 10"""),
    "weather_ingest_day": Query(weather_ingest_day, """
        SELECT user_id AS latitude, value AS humidity, '2024-02-01' AS observation_date,
               CAST(2024 AS INTEGER) AS year, CAST(2 AS INTEGER) AS month, CAST(1 AS INTEGER) AS day
        FROM events"""),
    "synonym_select": Query(synonym_select, """
        SELECT o_orderkey AS order_id, o_totalprice AS amount, o_orderstatus AS status FROM orders"""),
    "weather_daily": Query(weather_daily, _EXPECTED_DAILY),
    "weather_medallion": Query(weather_medallion, _EXPECTED_DAILY),
}
