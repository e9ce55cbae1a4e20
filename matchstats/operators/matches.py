"""Match-level models: the cleaned view over the typed table and the match facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import STAGED_COLUMNS
from .staging import drop_incomplete

# Fixed value: goals that make a match high-scoring.
HIGH_SCORING_GOALS = 5
# The result's columns in order.
FACT_COLUMNS = [
    "season", "season_start_year", "match_date", "home_team", "away_team",
    "home_goals", "away_goals", "total_goals",
    "result", "home_win", "away_win", "draw",
    "ht_home_goals", "ht_away_goals", "ht_result",
    "home_shots", "away_shots", "home_shots_on_target", "away_shots_on_target",
    "home_corners", "away_corners",
]


def stg_columns(stored_types: dict[str, str]) -> list[str]:
    """SQL of the cleaned columns, for the frame and for the view alike.

    The date is parsed only where it is stored as text.
    """
    changed = {team: f"trim({team}) AS {team}" for team in ("home_team", "away_team")}
    if stored_types["match_date"] != "date":
        changed["match_date"] = "try_to_date(match_date) AS match_date"
    return [changed.get(c, c) for c in STAGED_COLUMNS]


def stg_matches(matches: DataFrame) -> DataFrame:
    """Complete matches with trimmed team names.

    The null tests come first, on the stored columns, so that a Parquet scan can
    evaluate them.
    """
    return drop_incomplete(matches).selectExpr(*stg_columns(dict(matches.dtypes)))


def match_facts(stg: DataFrame, high_scoring_goals: int = HIGH_SCORING_GOALS) -> DataFrame:
    """One row per match with second-half goals, comeback and high-scoring flags.

    A comeback is a win after trailing at half time, by either side; without a
    half-time result there is none.
    """
    half, full = F.col("ht_result"), F.col("result")
    comeback = ((half == "A") & (full == "H")) | ((half == "H") & (full == "A"))
    return stg.select(
        *FACT_COLUMNS,
        (F.col("home_goals") - F.col("ht_home_goals")).alias("home_sh_goals"),
        (F.col("away_goals") - F.col("ht_away_goals")).alias("away_sh_goals"),
        F.coalesce(comeback, F.lit(False)).alias("comeback_win"),
        F.coalesce(F.col("total_goals") >= high_scoring_goals, F.lit(False)).alias("high_scoring"),
    )
