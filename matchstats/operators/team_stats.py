"""Per-team totals split by venue; every match counts once for each side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEAM_KEYS = ["season", "season_start_year", "team", "venue"]

# Measure, and the staged column it sums for the home side and for the away side.
SIDE_MEASURES = (
    ("wins", "home_win", "away_win"),
    ("draws", "draw", "draw"),
    ("losses", "away_win", "home_win"),
    ("goals_scored", "home_goals", "away_goals"),
    ("goals_conceded", "away_goals", "home_goals"),
    ("points", "home_points", "away_points"),
    ("shots", "home_shots", "away_shots"),
    ("shots_on_target", "home_shots_on_target", "away_shots_on_target"),
    ("yellow_cards", "home_yellow_cards", "away_yellow_cards"),
    ("red_cards", "home_red_cards", "away_red_cards"),
    ("corners", "home_corners", "away_corners"),
    ("fouls", "home_fouls", "away_fouls"),
)
# The result's columns in order.
TEAM_STATS_COLUMNS = [
    *TEAM_KEYS, "matches_played", "wins", "draws", "losses",
    "goals_scored", "goals_conceded", "goal_difference", "points",
    "shots", "shots_on_target", "yellow_cards", "red_cards", "corners", "fouls",
]


def side_columns() -> list[str]:
    """SQL of team and measures on a match's side named by ``venue``."""
    sides = (("team", "home_team", "away_team"), *SIDE_MEASURES)
    return [f"CASE venue WHEN 'home' THEN {home} ELSE {away} END AS {name}" for name, home, away in sides]


def total_columns() -> dict[str, str]:
    """SQL of each summed column over the sides."""
    sums = {name: f"sum({name})" for name, _, _ in SIDE_MEASURES}
    return sums | {
        "matches_played": "count(*)",
        "goal_difference": "sum(goals_scored) - sum(goals_conceded)",
    }


def _by_team(sides: DataFrame, counted: dict[str, Column]) -> DataFrame:
    measured = sides.select(
        "season", "season_start_year", "venue",
        *[F.expr(sql) for sql in side_columns()],
        *[test.alias(name) for name, test in counted.items()],
    )
    totals = measured.groupBy(*TEAM_KEYS).agg(
        *[F.expr(sql).alias(name) for name, sql in total_columns().items()],
        *[F.count_if(name).alias(name) for name in counted],
    )
    return totals.select(*TEAM_STATS_COLUMNS, *counted)


def team_stats(stg: DataFrame, counted: dict[str, Column] | None = None) -> DataFrame:
    """One row per season, team and venue, from a single scan.

    Each match is doubled by a two-element venue array and every measure picks its
    side. Map-side aggregation then leaves one row per group and task, so what is
    shuffled grows with seasons and teams, not with matches, and a dominant season
    or team costs no more than any other.

    ``counted`` adds columns that count the matches passing a test, on both sides.
    """
    sides = stg.withColumn("venue", F.explode(F.array(F.lit("home"), F.lit("away"))))
    return _by_team(sides, counted or {})


def home_stats(stg: DataFrame) -> DataFrame:
    """The home half alone."""
    return _by_team(stg.withColumn("venue", F.lit("home")), {})


def away_stats(stg: DataFrame) -> DataFrame:
    """The away half alone."""
    return _by_team(stg.withColumn("venue", F.lit("away")), {})
