"""Team statistics: clean team rows, rankings, country rollup."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import Bound, guarded_ratio, has_text, tier, typed, with_lineage
from ..operators.rank import overall_and_group_rank
from ..sinks.tables import replace_table
from ..sources.files import read_configured

# Fixed values.
NAMES = ["team", "team_country"]
WHOLE_NUMBERS = ["players_used", "games", "games_starts", "minutes", "goals", "assists",
                 "goals_assists", "goals_pens", "pens_made", "pens_att", "cards_yellow", "cards_red"]
DECIMALS = ["avg_age", "possession", "minutes_90s", "goals_per90", "assists_per90",
            "goals_assists_per90"]
OFFENSIVE_BOUNDS = [Bound(">=", 2.0, "elite"), Bound(">=", 1.5, "strong"),
                    Bound(">=", 1.0, "average")]
OFFENSIVE_BELOW = "developing"
MAX_PLAYERS = 26


def silver(bronze: DataFrame, strict: bool = False, now: dt.datetime | None = None) -> DataFrame:
    """Trimmed names, typed numbers and derived ratios; rows without a team name are dropped.

    Everything is one projection, since dozens of chained ones slow down analysis.
    """
    columns: dict[str, Column] = {c: F.trim(c) for c in NAMES}
    columns |= {c: typed(c, "int", strict) for c in WHOLE_NUMBERS}
    columns |= {c: typed(c, "double", strict) for c in DECIMALS}
    derived = {
        "cards_total": columns["cards_yellow"] + columns["cards_red"],
        "pen_conversion_rate": guarded_ratio(columns["pens_made"], columns["pens_att"]),
        "goal_involvement_per_game": guarded_ratio(columns["goals_assists"], columns["games"]),
        "minutes_per_game": guarded_ratio(columns["minutes"], columns["games"]),
    }
    clean = bronze.filter(has_text(columns["team"])).withColumns({**columns, **derived})
    return with_lineage(clean, ingested_at="_processed_at", now=now)


def by_offence(tie_break: Sequence[str] = ("team",)) -> list[Column]:
    """Best attack first; the tie-break makes equal teams rank the same way every time."""
    return [F.col("goals_assists_per90").desc_nulls_last(), F.col("goals_per90").desc_nulls_last(),
            *[F.col(c) for c in tie_break]]


def offensive_tier(column: str = "goals_assists_per90") -> Column:
    return tier(column, OFFENSIVE_BOUNDS, OFFENSIVE_BELOW)


def rankings(teams: DataFrame, tie_break: Sequence[str] = ("team",),
             now: dt.datetime | None = None) -> DataFrame:
    """Overall rank, rank within the country, and offensive tier."""
    ranked = overall_and_group_rank(teams, by_offence(tie_break), "overall_rank",
                                    ["team_country"], "country_rank")
    return with_lineage(ranked.withColumn("offensive_tier", offensive_tier()),
                        ingested_at="_refreshed_at", now=now)


def country_summary(teams: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    summary = teams.groupBy("team_country").agg(
        F.count(F.lit(1)).alias("team_count"),
        F.sum("goals").alias("total_goals"),
        F.sum("assists").alias("total_assists"),
        F.sum("goals_assists").alias("total_goal_involvements"),
        *[F.avg(c).alias(f"avg_{c}")
          for c in ("possession", "goals_per90", "assists_per90", "goals_assists_per90")],
        F.sum("cards_yellow").alias("total_yellow_cards"),
        F.sum("cards_red").alias("total_red_cards"),
        F.max("goals").alias("max_team_goals"))
    return with_lineage(summary, ingested_at="_refreshed_at", now=now)


def run(spark: SparkSession, target: str, **bronze_defaults: str) -> None:
    """Silver, then rankings and country summary, from the configured bronze table."""
    bronze = read_configured(spark, "bronze", **bronze_defaults)
    replace_table(silver(bronze), f"{target}.teams_silver")
    teams = spark.table(f"{target}.teams_silver")
    replace_table(rankings(teams), f"{target}.teams_gold_rankings")
    replace_table(country_summary(teams), f"{target}.teams_gold_country_summary")
