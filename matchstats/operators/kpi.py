"""Season indicators over the match facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ratios import mean, percentage, ratio


def match_kpi(facts: DataFrame) -> DataFrame:
    """One row per season, ordered by start year, in one aggregation of one scan.

    Averages leave out matches where the value is missing.
    """
    matches = F.count("*")
    home_wins, away_wins, draws = F.sum("home_win"), F.sum("away_win"), F.sum("draw")
    high_scoring = F.count_if(F.col("high_scoring"))
    half_time_goals = F.col("ht_home_goals") + F.col("ht_away_goals")
    return (
        facts.groupBy("season", "season_start_year")
        .agg(
            matches.alias("total_matches"),
            F.sum("total_goals").alias("total_goals"),
            mean(F.col("total_goals"), 2).alias("avg_goals_per_match"),
            mean(F.col("home_goals"), 2).alias("avg_home_goals"),
            mean(F.col("away_goals"), 2).alias("avg_away_goals"),
            mean(half_time_goals, 2).alias("avg_ht_goals"),
            home_wins.alias("home_wins"),
            away_wins.alias("away_wins"),
            draws.alias("draws"),
            percentage(home_wins, matches).alias("home_win_pct"),
            percentage(away_wins, matches).alias("away_win_pct"),
            percentage(draws, matches).alias("draw_pct"),
            ratio(home_wins, away_wins).alias("home_advantage_index"),
            mean(F.col("home_shots"), 1).alias("avg_home_shots"),
            mean(F.col("away_shots"), 1).alias("avg_away_shots"),
            mean(F.col("home_shots_on_target"), 1).alias("avg_home_sot"),
            mean(F.col("away_shots_on_target"), 1).alias("avg_away_sot"),
            mean(F.col("home_corners"), 1).alias("avg_home_corners"),
            mean(F.col("away_corners"), 1).alias("avg_away_corners"),
            high_scoring.alias("high_scoring_matches"),
            percentage(high_scoring, matches).alias("high_scoring_pct"),
            F.count_if(F.col("comeback_win")).alias("comeback_wins"),
        )
        .orderBy("season_start_year")
    )
