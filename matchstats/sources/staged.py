"""Staged Parquet and catalog tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.seasons import partition_condition, season_condition
from ..files import Files
from ..schemas import STAGED_SCHEMA


def read_staged(
    spark: SparkSession, path: str, seasons: str | Iterable[str] | None = None
) -> DataFrame:
    """Staged matches, season_start_year restored as an integer from the directory names.

    With ``seasons`` the rows are filtered and directories of other start years
    are never opened. The schema is given, so no file footer is read to infer it.
    """
    if not Files(spark).exists(path):
        raise FileNotFoundError(f"{path} has no staged matches")
    frame = spark.read.schema(STAGED_SCHEMA).parquet(path).select(*STAGED_SCHEMA.names)
    if seasons is None:
        return frame
    seasons = list(seasons.split(",") if isinstance(seasons, str) else seasons)
    return frame.where(
        partition_condition(seasons, F.col("season_start_year"))
        & season_condition(seasons, F.col("season"))
    )


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table or view."""
    return spark.table(table)


def require_rows(frame: DataFrame, name: str) -> DataFrame:
    """The frame itself, or an error when it holds no row; at most one row is fetched."""
    if frame.isEmpty():
        raise ValueError(f"{name} holds no rows")
    return frame
