"""From raw matches to staged matches: season filter, cleaning, enrichment."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.seasons import season_condition, start_year
from ..schemas import CRITICAL_COLUMNS, DATE_FORMAT, RAW_COLUMN_MAP, STAGED_COLUMNS

# Points.
POINTS_FOR_WIN = 3
POINTS_FOR_DRAW = 1
# The result's columns in order.
SAMPLE_COLUMNS = [
    "season", "match_date", "home_team", "away_team",
    "home_goals", "away_goals", "result", "total_goals",
]


def filter_seasons(raw: DataFrame, seasons: str | Iterable[str] | None = None) -> DataFrame:
    """Rows of the listed seasons, or of all; a null season is dropped, an empty list keeps nothing."""
    return raw.where(season_condition(seasons, F.col("Season")))


def _flag(result: Column, value: str) -> Column:
    return F.when(result == value, 1).otherwise(0)


def _points(result: Column, win: str) -> Column:
    return (
        F.when(result == win, POINTS_FOR_WIN).when(result == "D", POINTS_FOR_DRAW).otherwise(0)
    )


def clean_and_enrich(
    raw: DataFrame, ingested_at: datetime | None = None, blank_as_null: bool = False
) -> DataFrame:
    """All 30 staged columns, before incomplete rows are dropped.

    A malformed date or season becomes null instead of failing the job. Team names
    lose outer spaces; a name of spaces only stays as empty text unless
    ``blank_as_null`` is set. A null or unknown result is no win, no draw and no
    points for either side. ``ingested_at`` defaults to the time of the query.
    """
    result = F.col("FullTimeResult")
    columns = {staged: F.col(source) for source, staged, _ in RAW_COLUMN_MAP}
    for team in ("home_team", "away_team"):
        name = F.trim(columns[team])
        columns[team] = F.nullif(name, F.lit("")) if blank_as_null else name
    columns |= {
        "match_date": F.try_to_date("MatchDate", DATE_FORMAT),
        "total_goals": columns["home_goals"] + columns["away_goals"],
        "home_win": _flag(result, "H"),
        "away_win": _flag(result, "A"),
        "draw": _flag(result, "D"),
        "home_points": _points(result, "H"),
        "away_points": _points(result, "A"),
        "season_start_year": start_year(F.col("Season")),
        "ingested_at": F.current_timestamp() if ingested_at is None else F.lit(ingested_at),
    }
    return raw.select(*[columns[name].alias(name) for name in STAGED_COLUMNS])


def is_complete() -> Column:
    """True where every critical column holds a value."""
    return reduce(and_, [F.col(c).isNotNull() for c in CRITICAL_COLUMNS])


def drop_incomplete(enriched: DataFrame) -> DataFrame:
    """Rows holding every critical column, as plain null tests that a Parquet scan can evaluate."""
    return enriched.where(is_complete())


def stage_matches(
    raw: DataFrame, seasons: str | Iterable[str] | None = None, **options
) -> DataFrame:
    """Filter, clean and drop in one pass over the raw rows."""
    return drop_incomplete(clean_and_enrich(filter_seasons(raw, seasons), **options))


def count_staged(raw: DataFrame, seasons: str | Iterable[str] | None = None) -> DataFrame:
    """One row: rows read, rows of the chosen seasons, and those of them that are complete."""
    selected = F.coalesce(season_condition(seasons, F.col("season")), F.lit(False))
    return clean_and_enrich(raw).agg(
        F.count("*").alias("rows_read"),
        F.count_if(selected).alias("rows_selected"),
        F.count_if(selected & is_complete()).alias("rows_kept"),
    )


def rows_per_season(staged: DataFrame) -> DataFrame:
    return staged.groupBy("season").agg(F.count("*").alias("matches")).orderBy("season")


def sample_rows(staged: DataFrame, n: int = 5, ordered: bool = True) -> DataFrame:
    """The first ``n`` rows in order of all shown columns, so that re-runs agree.

    Not ``ordered``, any ``n`` rows: a look at the first files instead of all of them.
    """
    shown = staged.select(*SAMPLE_COLUMNS)
    return (shown.orderBy(*SAMPLE_COLUMNS) if ordered else shown).limit(n)
