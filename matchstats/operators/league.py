"""League table: season totals per team, rates and rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ratios import percentage, ratio

# Fixed values for a league of twenty teams.
TOP_RANKS = 4
RELEGATED_FROM = 18

# The result's columns in order.
LEAGUE_COLUMNS = [
    "season", "season_start_year", "team",
    "matches_played", "wins", "draws", "losses",
    "goals_scored", "goals_conceded", "goal_difference", "points",
    "win_rate_pct", "draw_rate_pct", "loss_rate_pct",
    "avg_goals_scored", "avg_goals_conceded",
    "yellow_cards", "red_cards", "shots", "shots_on_target", "shot_accuracy_pct",
    "season_rank", "top_4", "relegated",
]
_SUMMED = [
    "matches_played", "wins", "draws", "losses",
    "goals_scored", "goals_conceded", "goal_difference", "points",
    "yellow_cards", "red_cards", "shots", "shots_on_target",
]


def team_totals(stats: DataFrame) -> DataFrame:
    """Both venues of a team added up, with rates.

    The input holds at most two rows per team and season, so it is placed by season
    once; the totals here and the ranking after it then need no further shuffle.
    """
    played = F.col("matches_played")
    totals = (
        stats.repartition("season")
        .groupBy("season", "season_start_year", "team")
        .agg(*[F.sum(c).alias(c) for c in _SUMMED])
    )
    return totals.withColumns(
        {
            "win_rate_pct": percentage(F.col("wins"), played),
            "draw_rate_pct": percentage(F.col("draws"), played),
            "loss_rate_pct": percentage(F.col("losses"), played),
            "avg_goals_scored": ratio(F.col("goals_scored"), played),
            "avg_goals_conceded": ratio(F.col("goals_conceded"), played),
            "shot_accuracy_pct": percentage(F.col("shots_on_target"), F.col("shots")),
        }
    )


def rank_teams(
    totals: DataFrame, top_ranks: int = TOP_RANKS, relegated_from: int = RELEGATED_FROM
) -> DataFrame:
    """Rank in season by points, goal difference and goals; the team name settles full ties.

    A window partition is one season's teams, whatever the number of matches.
    """
    order = Window.partitionBy("season").orderBy(
        F.desc("points"), F.desc("goal_difference"), F.desc("goals_scored"), F.asc("team")
    )
    return totals.withColumn("season_rank", F.row_number().over(order)).withColumns(
        {
            "top_4": F.col("season_rank") <= top_ranks,
            "relegated": F.col("season_rank") >= relegated_from,
        }
    )


def league_table(
    stats: DataFrame, top_ranks: int = TOP_RANKS, relegated_from: int = RELEGATED_FROM
) -> DataFrame:
    """The ranked table, ordered by season and rank."""
    ranked = rank_teams(team_totals(stats), top_ranks, relegated_from)
    return ranked.select(*LEAGUE_COLUMNS).orderBy("season", "season_rank")
