"""Team statistics made from the whole ``orders`` table, and ranks over ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import guarded_ratio, steady_round
from ..operators.quality import alert_on_count
from ..operators.rank import global_rank, group_rank
from ..operators.summarize import count_where
from ..plans import teams
from .base import NOW, Query, fresh_schema, nullable, read, rounded

# Groups above this size take the range route already on small tables.

_NUMBERS = """
    CAST(20 + o_custkey % 10 AS INTEGER) AS players_used,
    floor(o_totalprice / 1e4) AS avg_age,
    floor(o_totalprice / 1e3) / 1e2 AS possession,
    CAST(o_custkey % 8 AS INTEGER) AS games,
    CAST(o_custkey % 8 AS INTEGER) AS games_starts,
    CAST(o_custkey % 8 * 88 AS INTEGER) AS minutes,
    o_custkey % 8 / 4e0 AS minutes_90s,
    CAST(o_orderkey % 21 AS INTEGER) AS goals,
    CAST(o_orderkey % 13 AS INTEGER) AS assists,
    CAST(o_orderkey % 21 + o_orderkey % 13 AS INTEGER) AS goals_assists,
    CAST(o_orderkey % 19 AS INTEGER) AS goals_pens,
    CAST(o_orderkey % 3 AS INTEGER) AS pens_made,
    CAST(o_custkey % 4 AS INTEGER) AS pens_att,
    CAST(o_orderkey % 9 AS INTEGER) AS cards_yellow,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey % 2 AS INTEGER) END AS cards_red,
    CASE WHEN o_custkey % 8 > 0 THEN floor(o_orderkey % 21 / (o_custkey % 8 + 0e0) * 8e0) / 8e0 END AS goals_per90,
    CASE WHEN o_custkey % 8 > 0 THEN floor(o_orderkey % 13 / (o_custkey % 8 + 0e0) * 8e0) / 8e0 END AS assists_per90,
    CASE WHEN o_custkey % 8 > 0 THEN floor((o_orderkey % 21 + o_orderkey % 13) / (o_custkey % 8 + 0e0) * 8e0) / 8e0
    END AS goals_assists_per90"""

_EXPECTED_SILVER = f"""
  SELECT *, cards_yellow + cards_red AS cards_total,
         CASE WHEN pens_att > 0 THEN pens_made / (pens_att + 0e0) END AS pen_conversion_rate,
         CASE WHEN games > 0 THEN goals_assists / (games + 0e0) END AS goal_involvement_per_game,
         CASE WHEN games > 0 THEN minutes / (games + 0e0) END AS minutes_per_game
  FROM (SELECT 'Team ' || o_orderkey AS team, o_orderpriority AS team_country, {_NUMBERS}
        FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW'))"""

_BY_OFFENCE = "ORDER BY goals_assists_per90 DESC NULLS LAST, goals_per90 DESC NULLS LAST, team"

_EXPECTED_RANKS = f"""
  SELECT team, team_country, goals_assists_per90, goals_per90,
         row_number() OVER ({_BY_OFFENCE}) AS overall_rank,
         row_number() OVER (PARTITION BY team_country {_BY_OFFENCE}) AS country_rank,
         CASE WHEN goals_assists_per90 >= 2.0 THEN 'elite' WHEN goals_assists_per90 >= 1.5 THEN 'strong'
              WHEN goals_assists_per90 >= 1.0 THEN 'average' ELSE 'developing' END AS offensive_tier
  FROM ({_EXPECTED_SILVER})"""

_EXPECTED_SUMMARY = f"""
  SELECT team_country, count(*) AS team_count, CAST(sum(goals) AS BIGINT) AS total_goals,
         CAST(sum(assists) AS BIGINT) AS total_assists,
         CAST(sum(goals_assists) AS BIGINT) AS total_goal_involvements,
         {rounded('avg(possession)', 6)} AS avg_possession, {rounded('avg(goals_per90)', 6)} AS avg_goals_per90,
         {rounded('avg(assists_per90)', 6)} AS avg_assists_per90,
         {rounded('avg(goals_assists_per90)', 6)} AS avg_goals_assists_per90,
         CAST(sum(cards_yellow) AS BIGINT) AS total_yellow_cards,
         CAST(sum(cards_red) AS BIGINT) AS total_red_cards, max(goals) AS max_team_goals
  FROM ({_EXPECTED_SILVER}) GROUP BY team_country"""

_AVERAGES = ("avg_possession", "avg_goals_per90", "avg_assists_per90", "avg_goals_assists_per90")


def landed_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One team per order, all columns text, names padded or blank."""
    blank = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    numbers = read(spark, sf_dir, "orders").selectExpr("*", *_split_list(_NUMBERS))
    return numbers.select(
        F.when(blank, "   ").otherwise(F.concat(F.lit("  Team "), "o_orderkey", F.lit(" "))).alias("team"),
        F.concat(F.lit(" "), "o_orderpriority").alias("team_country"),
        *[F.col(c).cast("string").alias(c) for c in [*teams.WHOLE_NUMBERS, *teams.DECIMALS]])


def _split_list(items: str) -> list[str]:
    """The entries of a SELECT list that has one ``AS name`` per entry."""
    return [entry.strip() for entry in items.replace("\n    END", " END").split(",\n")]


def team_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = teams.silver(landed_teams(spark, sf_dir)).drop("_processed_at")
    return clean.withColumns({c: nullable(c) for c in ("cards_red", "cards_total")})


def team_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = teams.rankings(teams.silver(landed_teams(spark, sf_dir)))
    return ranked.select("team", "team_country", "goals_assists_per90", "goals_per90",
                         "overall_rank", "country_rank", "offensive_tier")


def country_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = teams.country_summary(teams.silver(landed_teams(spark, sf_dir)), NOW)
    return summary.drop("_refreshed_at").withColumns({c: steady_round(c, 6) for c in _AVERAGES})


def team_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze table -> silver -> rankings and country summary; the ranked teams with their country's totals."""
    schema = fresh_schema(spark)
    landed_teams(spark, sf_dir).write.saveAsTable(f"{schema}.teams_bronze")
    teams.run(spark, schema, schema=schema, table="teams_bronze")
    totals = spark.table(f"{schema}.teams_gold_country_summary").select(
        "team_country", "team_count", "max_team_goals")
    return (spark.table(f"{schema}.teams_gold_rankings").join(totals, "team_country")
            .select("team", "team_country", "overall_rank", "country_rank", "offensive_tier",
                    "team_count", "max_team_goals"))


def line_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of every line item by price; the other columns break ties."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return global_rank(lines, [F.col("l_extendedprice").desc_nulls_last(), *lines.columns[:4]],
                       "price_rank")


def line_rank_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank within the return flag, whose few values each hold a third of the table."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return group_rank(lines, ["l_returnflag"],
                      [F.col("l_extendedprice").desc_nulls_last(), *lines.columns[1:5]],
                      "flag_rank")


def customer_rank_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer")
    return group_rank(customers, ["c_nationkey"],
                      [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey")], "nation_rank")


def discount_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guarded ratio: NULL where the denominator is zero."""
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        guarded_ratio("l_tax", "l_discount").alias("tax_per_discount"))


def large_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_where(read(spark, sf_dir, "part"), "p_size > 26", "records_breached")


def players_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row when teams use too many players, none otherwise."""
    return alert_on_count(teams.silver(landed_teams(spark, sf_dir)),
                          f"players_used > {teams.MAX_PLAYERS}")


QUERIES = {
    "team_silver": Query(team_silver, f"""
        SELECT * REPLACE (CAST(cards_red AS DOUBLE) AS cards_red, CAST(cards_total AS DOUBLE) AS cards_total)
        FROM ({_EXPECTED_SILVER})"""),
    "team_rankings": Query(team_rankings, _EXPECTED_RANKS),
    "country_summary": Query(country_summary, _EXPECTED_SUMMARY),
    "team_medallion": Query(team_medallion, f"""
        SELECT r.team, r.team_country, overall_rank, country_rank, offensive_tier, team_count, max_team_goals
        FROM ({_EXPECTED_RANKS}) r JOIN ({_EXPECTED_SUMMARY}) s ON r.team_country = s.team_country"""),
    "line_rank": Query(line_rank, """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber,
                                  l_partkey, l_suppkey) AS price_rank FROM lineitem"""),
    "line_rank_by_flag": Query(line_rank_by_flag, """
        SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               row_number() OVER (PARTITION BY l_returnflag
                                  ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber,
                                  l_partkey, l_suppkey) AS flag_rank FROM lineitem"""),
    "customer_rank_by_nation": Query(customer_rank_by_nation, """
        SELECT *, row_number() OVER (PARTITION BY c_nationkey
                                     ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS nation_rank
        FROM customer"""),
    "discount_ratio": Query(discount_ratio, """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE WHEN l_discount > 0 THEN l_tax / l_discount END AS tax_per_discount FROM lineitem"""),
    "large_parts": Query(large_parts, """
        SELECT count(*) AS records_breached FROM part WHERE p_size > 26"""),
    "players_alert": Query(players_alert, f"""
        SELECT count(*) AS records_breached FROM ({_EXPECTED_SILVER}) WHERE players_used > 26
        HAVING count(*) > 0"""),
}
