"""Sensor readings: landed CSV files, clean readings, daily summaries."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import Bound, tier, to_moment, typed
from ..operators.clean import drop_repeats, keep_members
from ..operators.summarize import spread_summary
from ..session import stage
from ..sinks.tables import replace_partitions, replace_table
from ..streaming.landing import append_stream, partition_stream

# Fixed values.
RENAMES = {"parameter": "pollutant", "units": "unit", "location": "location_name",
           "lat": "latitude", "lon": "longitude"}
DAY_KEYS = ["location_id", "location_name", "pollutant", "unit", "latitude", "longitude",
            "measured_date", "measured_year", "measured_month"]
READING_KEYS = ["location_id", "pollutant", "measured_at"]
MONTH_LAYOUT = ["measured_year", "measured_month"]
PM25_BOUNDS = [
    Bound("<=", 12.0, "Good"),
    Bound("<=", 35.4, "Moderate"),
    Bound("<=", 55.4, "Unhealthy for Sensitive Groups"),
    Bound("<=", 150.4, "Unhealthy"),
]
PM25_ABOVE = "Very Unhealthy"
HUMIDITY_BOUNDS = [
    Bound("<", 60.0, "Low"),
    Bound("<=", 70.0, "Medium"),
    Bound("<=", 75.0, "High"),
]
HUMIDITY_ABOVE = "Very High"


def bronze_stream(spark: SparkSession, root: str, schema: T.StructType,
                  location_ids: Iterable[int], years: Iterable[int]) -> DataFrame:
    """Stream of the CSV files of some locations and years; both become columns."""
    return partition_stream(spark, root, "csv", schema, {"header": "true"},
                            locationid=location_ids, year=years)


def silver(bronze: DataFrame, location_ids: Sequence[int] | DataFrame | None = None,
           strict: bool = False, zone: str | None = None,
           prefer: Sequence | None = None) -> DataFrame:
    """Typed, renamed readings, one per location, pollutant and moment.

    Readings that are NULL, not a number, or negative are dropped. ``prefer`` orders the copies
    of one reading (by output column) and keeps the first; without it any copy is kept.
    """
    rows = bronze if location_ids is None else keep_members(bronze, "location_id", location_ids)
    rows = (rows.drop("locationid")
            .withColumns({"measured_at": to_moment("datetime", strict, zone),
                          "value": typed("value", "double", strict)})
            .filter((F.col("value") >= 0) & ~F.isnan("value"))  # NULL fails the comparison; NaN would not
            .withColumns({"measured_date": F.to_date("measured_at"),
                          "measured_year": F.year("measured_at"),
                          "measured_month": F.month("measured_at")})
            .withColumnsRenamed(RENAMES)
            .drop("datetime"))
    return drop_repeats(rows, READING_KEYS, prefer)


def pm25_category(average: str = "daily_avg", pollutant: str = "pollutant"):
    return tier(average, PM25_BOUNDS, PM25_ABOVE, applies=F.col(pollutant) == "pm25")


def humidity_index(highest: str = "daily_max", pollutant: str = "pollutant"):
    return tier(highest, HUMIDITY_BOUNDS, HUMIDITY_ABOVE,
                applies=F.col(pollutant) == "relativehumidity")


def gold(readings: DataFrame) -> DataFrame:
    """Daily statistics per location and pollutant with their categories."""
    return spread_summary(readings, DAY_KEYS, "value").withColumns(
        {"pm25_aqi_category": pm25_category(), "rel_humidity_index": humidity_index()})


def months_of(rows: DataFrame) -> Column | None:
    """A condition on the partition columns that holds for the months of ``rows``; None without rows."""
    months = rows.select(*MONTH_LAYOUT).distinct().collect()  # a row per month
    each = [reduce(and_, [F.col(c).eqNullSafe(F.lit(r[c])) for c in MONTH_LAYOUT]) for r in months]
    return reduce(or_, each) if each else None


def refresh(fresh_bronze: DataFrame, clean: str, daily: str, prefer: Sequence | None = None,
            location_ids: Sequence[int] | None = None) -> None:
    """Bring the clean and daily tables up to date with new bronze rows.

    Only the months that these rows touch are read and written. A reading that is already there
    competes with its new copies by ``prefer``, so that late and corrected readings give the tables that a
    rebuild from all of bronze would give, and repeated rows change nothing.
    """
    spark = fresh_bronze.sparkSession
    fresh = stage(silver(fresh_bronze, location_ids, prefer=prefer), "fresh")
    touched = months_of(fresh)
    if touched is None:
        return
    if spark.catalog.tableExists(clean):
        known = spark.table(clean).where(touched)
        # staged, because the partitions that are read are those that are replaced
        fresh = stage(drop_repeats(known.unionByName(fresh, allowMissingColumns=True), READING_KEYS, prefer), "merged")
    replace_partitions(fresh, clean, MONTH_LAYOUT)
    replace_partitions(gold(spark.table(clean).where(touched)), daily, MONTH_LAYOUT)


def run_incremental(spark: SparkSession, root: str, csv_schema: T.StructType, schema: str, checkpoint: str,
                    location_ids: Sequence[int], years: Iterable[int], prefer: Sequence | None = None) -> None:
    """As :func:`run`, but silver and gold follow what is new in bronze, month by month."""
    raw, clean, daily = (f"{schema}.{name}" for name in
                         ("bronze_readings_raw", "silver_readings_clean", "gold_readings_daily"))
    append_stream(bronze_stream(spark, root, csv_schema, location_ids, years), raw, checkpoint).awaitTermination()

    def follow(batch: DataFrame, _: int) -> None:
        refresh(batch, clean, daily, prefer, location_ids)

    # a batch may be repeated after a crash: refreshing twice is refreshing once
    (spark.readStream.table(raw).writeStream.foreachBatch(follow).option("checkpointLocation", f"{checkpoint}-silver")
     .trigger(availableNow=True).start().awaitTermination())


def run(spark: SparkSession, root: str, csv_schema: T.StructType, schema: str, checkpoint: str,
        location_ids: Sequence[int], years: Iterable[int], prefer: Sequence | None = None) -> None:
    """Bronze, silver and gold tables in that order, each from the table before."""
    raw, clean, daily = (f"{schema}.{name}" for name in
                         ("bronze_readings_raw", "silver_readings_clean", "gold_readings_daily"))
    stream = bronze_stream(spark, root, csv_schema, location_ids, years)
    append_stream(stream, raw, checkpoint).awaitTermination()
    replace_table(silver(spark.table(raw), location_ids, prefer=prefer), clean, MONTH_LAYOUT)
    replace_table(gold(spark.table(clean)), daily, MONTH_LAYOUT)
