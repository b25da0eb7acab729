"""The medallion jobs on small hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siltworks.plans import air_quality, teams, weather

READINGS = "location_id long, locationid long, datetime string, value string, parameter string, units string, location string, lat double, lon double"
HARBOUR, MILL = ("Harbour", -33.5, 18.25), ("Old mill", 61.0, -149.5)


def readings(spark):
    def row(station, place, when, value, what="pm25", unit="ppb"):
        return station, station, when, value, what, unit, *place

    good = row(41, HARBOUR, "2021-11-30 23:59:59", "17.75")
    rows = [good, good, row(41, HARBOUR, "2021-12-01 00:00:01", None), row(41, HARBOUR, "2021-12-01 06:30:00", "-0.5"),
            row(41, HARBOUR, "2021-12-01 07:00:00", "n/a"), row(52, MILL, "2021-12-02 08:00:00", "3"),
            row(63, MILL, "2022-01-01 00:00:00", "88.5", "relativehumidity", "pct"),
            row(63, MILL, "2022-01-01 01:00:00", "NaN", "relativehumidity", "pct")]
    return spark.createDataFrame(rows, READINGS)


def test_silver_readings(spark):
    clean = air_quality.silver(readings(spark), [41, 63])
    assert set(clean.columns) == {
        "location_id", "value", "pollutant", "unit", "location_name", "latitude", "longitude",
        "measured_at", "measured_date", "measured_year", "measured_month"}
    got = clean.select("location_id", "value", "measured_year", "measured_month",
                       F.col("measured_date").cast("string")).orderBy("location_id").collect()
    assert [tuple(r) for r in got] == [(41, 17.75, 2021, 11, "2021-11-30"), (63, 88.5, 2022, 1, "2022-01-01")]


def test_silver_keeps_preferred_copy(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", "5", "pm25"), (1, "2024-01-01 00:00:00", "3", "pm25")],
                               "location_id long, datetime string, value string, parameter string")
    assert air_quality.silver(df, prefer=["value"]).first().value == 3.0


def test_members_as_table(spark):
    ids = spark.createDataFrame([(63,)], "id long")
    assert [r.location_id for r in air_quality.silver(readings(spark), ids).collect()] == [63]


def test_gold_readings(spark):
    day = spark.createDataFrame(
        [(7, "pm25", 30.0), (7, "pm25", 36.0), (7, "pm25", None), (7, "relativehumidity", 12.0), (8, "pm25", 160.5)],
        "location_id long, pollutant string, value double").selectExpr(
        "*", "'Quay' AS location_name", "'ppb' AS unit", "0.5D AS latitude", "-0.5D AS longitude", "'2022-02-28' AS measured_date",
        "2022L AS measured_year", "2L AS measured_month")
    got = {(r.location_id, r.pollutant): r for r in air_quality.gold(day).collect()}
    dust = got[(7, "pm25")]
    assert (dust.daily_avg, dust.daily_max, dust.daily_min, dust.daily_stddev, dust.reading_count) == (33.0, 36.0, 30.0, 4.2426, 2)
    assert dust.pm25_aqi_category == "Moderate" and dust.rel_humidity_index is None
    damp = got[(7, "relativehumidity")]
    assert damp.rel_humidity_index == "Low" and damp.pm25_aqi_category is None
    assert got[(8, "pm25")].daily_stddev is None and got[(8, "pm25")].pm25_aqi_category == "Very Unhealthy"


def team_rows(spark):
    base = dict(team=" Alpha ", team_country=" X ", players_used="26", avg_age="27.5", possession="55.1",
                games="4", games_starts="44", minutes="360", minutes_90s="4.0", goals="6", assists="4",
                goals_assists="10", goals_pens="5", pens_made="1", pens_att="2", cards_yellow="3",
                cards_red="1", goals_per90="1.5", assists_per90="1.0", goals_assists_per90="2.5")
    rows = [base, {**base, "team": "Beta", "goals_assists_per90": "1.5", "pens_att": "0", "games": "0"},
            {**base, "team": "Gamma", "goals_assists_per90": "1.5", "cards_red": None, "goals": "bad"},
            {**base, "team": "Delta", "team_country": "Y", "goals_assists_per90": None},
            {**base, "team": "   "}, {**base, "team": None}]
    return spark.createDataFrame([tuple(r.values()) for r in rows],
                                 ", ".join(f"{c} string" for c in base))


def test_team_silver(spark, now):
    got = {r.team: r for r in teams.silver(team_rows(spark), now=now).collect()}
    assert set(got) == {"Alpha", "Beta", "Gamma", "Delta"}
    alpha, beta, gamma = got["Alpha"], got["Beta"], got["Gamma"]
    assert (alpha.team_country, alpha.cards_total, alpha.pen_conversion_rate) == ("X", 4, 0.5)
    assert (alpha.goal_involvement_per_game, alpha.minutes_per_game) == (2.5, 90.0)
    assert (beta.pen_conversion_rate, beta.goal_involvement_per_game, beta.minutes_per_game) == (None,) * 3
    assert gamma.cards_total is None and gamma.goals is None


def test_team_rankings_break_ties_by_name(spark):
    ranked = teams.rankings(teams.silver(team_rows(spark)))
    got = {r.team: (r.overall_rank, r.country_rank, r.offensive_tier) for r in ranked.collect()}
    assert got == {"Alpha": (1, 1, "elite"), "Beta": (2, 2, "strong"), "Gamma": (3, 3, "strong"),
                   "Delta": (4, 1, "developing")}


def test_country_summary(spark):
    got = {r.team_country: r for r in teams.country_summary(teams.silver(team_rows(spark))).collect()}
    assert (got["X"].team_count, got["X"].total_goals, got["X"].max_team_goals) == (3, 12, 6)
    assert got["X"].total_red_cards == 2 and got["Y"].avg_goals_assists_per90 is None


def test_weather_prefers_date_like_column_over_timestamp(spark):
    raw = spark.createDataFrame([("Oslo", "2024-03-02 23:30:00", "2024-03-01", "x")],
                                "`Location Name` string, last_updated string, `reportDate` string, temp string")
    row = weather.silver(raw).first()
    assert (row.city, str(row.observation_date), row.mean_temperature) == ("Oslo", "2024-03-01", None)
    assert (row.year, row.month, row.day) == (2024, 3, 1)


def test_weather_matched_date_is_passed_through(spark):
    raw = spark.createDataFrame([("A", "2024-03-01"), ("A", None), (None, "2024-03-01")],
                                "city string, date string")
    got = weather.silver(raw)
    assert dict(got.dtypes)["observation_date"] == "string"
    assert [tuple(r) for r in got.select("city", "observation_date", "month").collect()] == [("A", "2024-03-01", 3)]


def test_weather_epoch_only(spark):
    raw = spark.createDataFrame([("N", 1709337600)], "country string, last_updated_epoch long")
    row = weather.silver(raw).first()
    assert str(row.observation_timestamp) == "2024-03-02 00:00:00" and str(row.observation_date) == "2024-03-02"


def test_weather_falls_back_to_ingest_day(spark, now):
    raw = weather.bronze(spark.createDataFrame([(3.0,)], "humidity double"), now)
    row = weather.silver(raw).first()
    assert str(row.observation_date) == "2024-02-01" and row.humidity == 3.0


def test_weather_without_any_date(spark):
    raw = spark.createDataFrame([(3.0,)], "humidity double")
    assert weather.silver(raw).columns == ["humidity"]
    with pytest.raises(ValueError, match="observation_date"):
        weather.gold(weather.silver(raw))


def test_weather_gold_derives_date_and_adapts(spark):
    df = spark.createDataFrame([("A", "2024-03-01 01:00:00", 2.0), ("A", "2024-03-01 05:00:00", 4.0)],
                               "city string, t string, mean_temperature double")
    df = df.select("city", F.to_timestamp("t").alias("observation_timestamp"), "mean_temperature")
    got = weather.gold(df)
    assert got.columns == ["city", "observation_date", "observation_count", "avg_mean_temperature"]
    assert tuple(got.select("observation_count", "avg_mean_temperature").first()) == (2, 3.0)


def test_weather_later_of_two_like_names_wins(spark):
    raw = spark.createDataFrame([("a", "b", "2024-01-01")], "`Ci ty` string, city string, date string")
    assert weather.silver(raw).first().city == "b"
