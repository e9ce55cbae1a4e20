"""Column names, types and layouts shared by every step.

The tables below are fixed values: the raw file's header, the staged names the
models read, and the typed table's column types.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values: (raw column, staged column, Spark type once typed).
RAW_COLUMN_MAP = (
    ("Season", "season", "string"),
    ("MatchDate", "match_date", "date"),
    ("HomeTeam", "home_team", "string"),
    ("AwayTeam", "away_team", "string"),
    ("FullTimeHomeGoals", "home_goals", "int"),
    ("FullTimeAwayGoals", "away_goals", "int"),
    ("FullTimeResult", "result", "string"),
    ("HalfTimeHomeGoals", "ht_home_goals", "int"),
    ("HalfTimeAwayGoals", "ht_away_goals", "int"),
    ("HalfTimeResult", "ht_result", "string"),
    ("HomeShots", "home_shots", "int"),
    ("AwayShots", "away_shots", "int"),
    ("HomeShotsOnTarget", "home_shots_on_target", "int"),
    ("AwayShotsOnTarget", "away_shots_on_target", "int"),
    ("HomeCorners", "home_corners", "int"),
    ("AwayCorners", "away_corners", "int"),
    ("HomeFouls", "home_fouls", "int"),
    ("AwayFouls", "away_fouls", "int"),
    ("HomeYellowCards", "home_yellow_cards", "int"),
    ("AwayYellowCards", "away_yellow_cards", "int"),
    ("HomeRedCards", "home_red_cards", "int"),
    ("AwayRedCards", "away_red_cards", "int"),
)

RAW_COLUMNS = [raw for raw, _, _ in RAW_COLUMN_MAP]
RAW_INT_COLUMNS = [raw for raw, _, kind in RAW_COLUMN_MAP if kind == "int"]
DATE_FORMAT = "yyyy-MM-dd"

# A staged row without one of these is dropped.
CRITICAL_COLUMNS = ["match_date", "home_team", "away_team", "home_goals", "away_goals"]

# Typed table, in the order its DDL declares the columns.
WAREHOUSE_COLUMNS = (
    ("match_date", "DATE"),
    ("home_team", "VARCHAR(100)"),
    ("away_team", "VARCHAR(100)"),
    ("home_goals", "INT"),
    ("away_goals", "INT"),
    ("total_goals", "INT"),
    ("result", "VARCHAR(1)"),
    ("home_win", "INT"),
    ("away_win", "INT"),
    ("draw", "INT"),
    ("home_points", "INT"),
    ("away_points", "INT"),
    ("ht_home_goals", "INT"),
    ("ht_away_goals", "INT"),
    ("ht_result", "VARCHAR(1)"),
    ("home_shots", "INT"),
    ("away_shots", "INT"),
    ("home_shots_on_target", "INT"),
    ("away_shots_on_target", "INT"),
    ("home_yellow_cards", "INT"),
    ("away_yellow_cards", "INT"),
    ("home_red_cards", "INT"),
    ("away_red_cards", "INT"),
    ("home_corners", "INT"),
    ("away_corners", "INT"),
    ("home_fouls", "INT"),
    ("away_fouls", "INT"),
    ("season", "VARCHAR(10)"),
    ("season_start_year", "INT"),
    ("ingested_at", "VARCHAR(50)"),
)

# Order of the staged frame's 30 columns.
STAGED_COLUMNS = [
    "season", "season_start_year", "match_date",
    "home_team", "away_team",
    "home_goals", "away_goals", "total_goals",
    "result", "home_win", "away_win", "draw",
    "home_points", "away_points",
    "ht_home_goals", "ht_away_goals", "ht_result",
    "home_shots", "away_shots", "home_shots_on_target", "away_shots_on_target",
    "home_yellow_cards", "away_yellow_cards", "home_red_cards", "away_red_cards",
    "home_corners", "away_corners", "home_fouls", "away_fouls",
    "ingested_at",
]

_STAGED_TYPES = {
    "match_date": T.DateType(),
    "ingested_at": T.TimestampType(),
    **{name: T.StringType() for name in ("season", "home_team", "away_team", "result", "ht_result")},
}

STAGED_SCHEMA = T.StructType(
    [T.StructField(name, _STAGED_TYPES.get(name, T.IntegerType())) for name in STAGED_COLUMNS]
)

# A raw row as it looks once its numbers are typed; the date stays text.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(raw, T.IntegerType() if kind == "int" else T.StringType())
        for raw, _, kind in RAW_COLUMN_MAP
    ]
)
