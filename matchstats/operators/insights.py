"""Questions asked of the two marts; each reads a season-sized table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def champions(league: DataFrame, k: int = 1) -> DataFrame:
    """The best ``k`` teams of each season."""
    return (
        league.where(F.col("season_rank") <= k)
        .select("season", "season_start_year", "season_rank", "team", "points", "goal_difference")
        .orderBy("season", "season_rank")
    )


def win_rate_trend(league: DataFrame) -> DataFrame:
    """Win rate and goals per team over the seasons."""
    return league.select(
        "team", "season", "season_start_year", "matches_played", "win_rate_pct",
        "goals_scored", "goals_conceded", "avg_goals_scored", "avg_goals_conceded",
    ).orderBy("team", "season_start_year")


def home_advantage(kpi: DataFrame) -> DataFrame:
    """Home and away success by season; an index over 1 means home teams win more."""
    return kpi.select(
        "season", "season_start_year", "home_win_pct", "away_win_pct", "draw_pct",
        "home_advantage_index",
    ).orderBy("season_start_year")


def goals_trend(kpi: DataFrame) -> DataFrame:
    """Goals per match by season."""
    return kpi.select(
        "season", "season_start_year", "total_matches", "total_goals", "avg_goals_per_match",
        "avg_home_goals", "avg_away_goals", "avg_ht_goals", "high_scoring_pct",
    ).orderBy("season_start_year")


def highest_scoring_season(kpi: DataFrame) -> DataFrame:
    """The season with most goals per match; the earlier one on a tie."""
    best = F.max(
        F.struct("avg_goals_per_match", (-F.col("season_start_year")).alias("earlier"), "season")
    )
    return kpi.agg(best.alias("best")).select("best.season", "best.avg_goals_per_match")


def top_teams(league: DataFrame, k: int = 10) -> DataFrame:
    """Teams with most points over all seasons; goal difference, then name, settle ties."""
    return (
        league.groupBy("team")
        .agg(
            F.count("*").alias("seasons"),
            F.sum("matches_played").alias("matches_played"),
            F.sum("wins").alias("wins"),
            F.sum("points").alias("points"),
            F.sum("goal_difference").alias("goal_difference"),
            F.sum("goals_scored").alias("goals_scored"),
        )
        .orderBy(F.desc("points"), F.desc("goal_difference"), "team")
        .limit(k)
    )


def home_win_change(kpi: DataFrame) -> DataFrame:
    """One row: home win % of the first and last season, their difference, and the lowest."""
    year, pct = F.col("season_start_year"), F.col("home_win_pct")
    ends = kpi.agg(
        F.min(F.struct(year, "season", pct)).alias("first"),
        F.max(F.struct(year, "season", pct)).alias("last"),
        F.min(F.struct(pct, year, "season")).alias("lowest"),
    )
    return ends.select(
        F.col("first.season").alias("first_season"),
        F.col("first.home_win_pct").alias("first_home_win_pct"),
        F.col("last.season").alias("last_season"),
        F.col("last.home_win_pct").alias("last_home_win_pct"),
        F.round(F.col("last.home_win_pct") - F.col("first.home_win_pct"), 1).alias("change_pct"),
        F.col("lowest.season").alias("lowest_season"),
        F.col("lowest.home_win_pct").alias("lowest_home_win_pct"),
    )
