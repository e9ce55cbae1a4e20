"""Staged Parquet, one directory per season start year."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.seasons import season_condition
from ..operators.staging import clean_and_enrich, count_staged, is_complete
from ..sources.staged import read_staged
from .layout import place_by_month, session_settings, sort_matches, write_settings


@dataclass(frozen=True)
class StagedCounts:
    """Raw rows read, rows of the chosen seasons, and the complete ones that were written."""

    rows_read: int
    rows_selected: int
    rows_kept: int

    @property
    def rows_dropped(self) -> int:
        return self.rows_selected - self.rows_kept


def write_staged(
    staged: DataFrame,
    path: str,
    replace_all: bool = True,
    max_records_per_file: int | None = None,
) -> None:
    """Overwrite the staged Parquet.

    ``replace_all`` removes seasons that are no longer in the input; without it only
    the seasons being written are replaced.
    """
    writer = (
        sort_matches(place_by_month(staged))
        .write.mode("overwrite")
        .partitionBy("season_start_year")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    spark = staged.sparkSession
    with session_settings(spark, write_settings(spark)):
        writer.parquet(path)


def observed(observation: Observation) -> dict | None:
    """The observed values, or none where Spark knew beforehand that no row was left."""
    try:
        return observation.get
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return None


def _in_years(year: Column, years: list[int], without_year: bool) -> Column:
    return year.isin(years) | year.isNull() if without_year else year.isin(years)


def stage_and_write(
    raw: DataFrame,
    seasons: str | Iterable[str] | None,
    path: str,
    ingested_at: datetime | None = None,
    **options,
) -> StagedCounts:
    """Filter, clean, drop and write in one pass, counting the rows on the way.

    The counts are observed while the write runs, so there is no second scan. Tasks
    repeated after an executor was lost are observed again; so the rows written are held
    against those in the files of the seasons written, a look at their footers, and all
    counts are taken anew from the source if the two differ.
    """
    spark = raw.sparkSession
    read, kept = Observation(), Observation()
    selected = season_condition(seasons, F.col("Season"))
    watched = raw.observe(
        read,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.coalesce(selected, F.lit(False))).alias("rows_selected"),
    )
    staged = clean_and_enrich(watched.where(selected), ingested_at=ingested_at)
    staged = staged.where(is_complete()).observe(
        kept,
        F.count(F.lit(1)).alias("rows_kept"),
        F.collect_set("season_start_year").alias("years"),
        F.count_if(F.col("season_start_year").isNull()).alias("yearless"),
    )
    write_staged(staged, path, **options)
    before, after = observed(read), observed(kept)
    if before and after:
        here = _in_years(F.col("season_start_year"), list(after["years"]), after["yearless"] > 0)
        if read_staged(spark, path).where(here).count() == after["rows_kept"]:
            return StagedCounts(**before, rows_kept=after["rows_kept"])
    return StagedCounts(**count_staged(raw, seasons).first().asDict())
