"""Weather observations whose column names differ from source to source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import any_present, from_epoch_or_text, to_day, typed, with_lineage
from ..operators.conform import find_date_column, plain_name, resolve_synonyms
from ..operators.summarize import adaptive_summary
from ..sinks.tables import replace_table

# Output column and the names it may have in the source, most wanted first.
SYNONYMS = {
    "station": ["station", "station_name", "weather_station"],
    "city": ["city", "town", "location", "location_name"],
    "country": ["country", "nation", "country_name"],
    "latitude": ["latitude", "lat"],
    "longitude": ["longitude", "lon", "lng"],
    "observation_date": ["observation_date", "date", "observationdate", "measurementdate"],
    "observation_timestamp": ["observation_timestamp", "datetime", "timestamp", "time",
                              "observationtimestamp", "last_updated", "lastupdated",
                              "last_updated_epoch", "lastupdatedepoch", "localtime",
                              "localtime_epoch", "localtimeepoch"],
    "mean_temperature": ["mean_temperature", "mean_temp", "avg_temperature",
                         "average_temperature", "meantemp", "temperature", "temp"],
    "max_temperature": ["max_temperature", "max_temp", "highest_temperature", "maxtemp"],
    "min_temperature": ["min_temperature", "min_temp", "lowest_temperature", "mintemp"],
    "precipitation": ["precipitation", "rain_mm", "rainfall", "precip", "rain"],
    "humidity": ["humidity", "relative_humidity", "rh"],
    "wind_speed": ["wind_speed", "wind_mph", "wind_kph", "wind", "windspeed"],
}
NOT_OBSERVATION_DATES = {"ingestiondate", "ingestedat", "updatedat", "lastupdatedepoch",
                         "localtimeepoch"}
NUMBERS = ["mean_temperature", "max_temperature", "min_temperature", "precipitation", "humidity",
           "wind_speed"]
PLACES = ["country", "city", "station"]
DAY_MEASURES = {
    "avg_mean_temperature": ("avg", "mean_temperature"),
    "max_temperature": ("max", "max_temperature"),
    "min_temperature": ("min", "min_temperature"),
    "total_precipitation": ("sum", "precipitation"),
    "avg_humidity": ("avg", "humidity"),
    "avg_wind_speed": ("avg", "wind_speed"),
}


def bronze(raw: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    return with_lineage(raw, ingested_at="_ingested_at", ingestion_date="_ingestion_date", now=now)


def observation_date(columns: list[str], found: dict[str, str], strict: bool) -> Column | None:
    """Best source of the date: its own synonym, any date-like column, the timestamp, the ingest day.

    A column matched by synonym is passed through as it is.
    """
    if "observation_date" in found:
        return F.col(f"`{found['observation_date']}`")
    dated = find_date_column(columns, NOT_OBSERVATION_DATES)
    if dated:
        return to_day(F.col(f"`{dated}`"), strict)
    if "observation_timestamp" in found:
        return F.to_date(_moment(found["observation_timestamp"], strict))
    return to_day("_ingestion_date", strict) if "_ingestion_date" in columns else None


def _moment(source: str, strict: bool) -> Column:
    return from_epoch_or_text(f"`{source}`", plain_name(source).endswith("epoch"), strict)


def silver(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Known columns under their standard names, typed, with date parts; undated rows and rows
    without any place are dropped. Which columns exist is settled while planning."""
    found = resolve_synonyms(raw.columns, SYNONYMS)
    columns: dict[str, Column] = {}
    for target, source in found.items():
        column = F.col(f"`{source}`")
        if target == "observation_timestamp":
            column = _moment(source, strict)
        elif target in NUMBERS:
            column = typed(column, "double", strict)
        columns[target] = column
    date = observation_date(raw.columns, found, strict)
    if date is not None:
        columns["observation_date"] = date
    clean = raw.select(*[column.alias(name) for name, column in columns.items()])
    if date is None:
        return clean
    day = to_day("observation_date", strict)
    clean = clean.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})
    clean = clean.filter(F.col("observation_date").isNotNull())
    places = [p for p in PLACES if p in columns]
    return clean.filter(any_present(places)) if places else clean


def gold(observations: DataFrame) -> DataFrame:
    """Daily summary by the place columns there are; the date may come from the timestamp."""
    if "observation_date" not in observations.columns:
        if "observation_timestamp" not in observations.columns:
            raise ValueError("a weather summary needs observation_date or observation_timestamp")
        observations = observations.withColumn("observation_date", F.to_date("observation_timestamp"))
    return adaptive_summary(observations, [*PLACES, "observation_date"], DAY_MEASURES,
                            "observation_count")


def run(spark: SparkSession, raw: DataFrame, schema: str, now: dt.datetime | None = None) -> None:
    layers = [f"{schema}.{layer}_weather" for layer in ("bronze", "silver", "gold")]
    replace_table(bronze(raw, now), layers[0])
    replace_table(silver(spark.table(layers[0])), layers[1])
    replace_table(gold(spark.table(layers[1])), layers[2])
