"""Catalog views over the typed match table.

A stored view needs SQL text; it is put together from the same expressions as the frames
of ``operators.matches.stg_matches`` and ``operators.team_stats.team_stats``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.matches import stg_columns
from ..operators.team_stats import TEAM_KEYS, TEAM_STATS_COLUMNS, side_columns, total_columns
from ..schemas import CRITICAL_COLUMNS


def stg_matches_sql(matches: str, stored_types: dict[str, str]) -> str:
    complete = " AND ".join(f"{c} IS NOT NULL" for c in CRITICAL_COLUMNS)
    return f"SELECT {', '.join(stg_columns(stored_types))} FROM {matches} WHERE {complete}"


def team_stats_sql(stg: str) -> str:
    totals = total_columns()
    columns = ", ".join(f"{totals[c]} AS {c}" if c in totals else c for c in TEAM_STATS_COLUMNS)
    return f"""
        SELECT {columns}
        FROM (
            SELECT season, season_start_year, venue, {", ".join(side_columns())}
            FROM {stg} LATERAL VIEW explode(array('home', 'away')) AS venue
        )
        GROUP BY {", ".join(TEAM_KEYS)}
    """


def create_model_views(spark: SparkSession, raw: str, staging: str) -> dict[str, str]:
    """Create or replace both views; returns model name -> view name."""
    views = {name: f"{staging}.{name}" for name in ("stg_matches", "int_team_stats")}
    matches = f"{raw}.matches"
    stored = dict(spark.table(matches).dtypes)
    spark.sql(f"CREATE OR REPLACE VIEW {views['stg_matches']} AS {stg_matches_sql(matches, stored)}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {views['int_team_stats']} AS {team_stats_sql(views['stg_matches'])}"
    )
    return views
