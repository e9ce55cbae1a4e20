"""The whole run: profile, stage, reload, model, check.

Plain function calls in order; every step reads what the one before it wrote, so a
step that failed can be run again by itself.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import (
    coverage_report,
    enforce,
    header_report,
    load_report,
    quality_report,
)
from ..operators.profile import season_coverage, settled, summarise
from ..sinks.staged import StagedCounts, stage_and_write
from ..sinks.tables import create_matches_table, create_schema, reload_matches, save_mart
from ..sinks.versions import verify_version
from ..sinks.views import create_model_views
from ..schemas import RAW_COLUMNS
from ..sources.raw_csv import header, read_raw, read_raw_text
from ..sources.staged import read_staged, read_table, require_rows
from .models import CLUSTERED, MARTS, WriteChecks, build_mart


@dataclass(frozen=True)
class Schemas:
    """Catalog schemas the run writes to.

    ``location`` is the folder of their tables. Without it they lie where the catalog
    puts them, which asks for a catalog that outlives the session.
    """

    raw: str = "raw"
    staging: str = "staging"
    marts: str = "marts"
    location: str | None = None

    @property
    def matches(self) -> str:
        return f"{self.raw}.matches"

    def path(self, table: str) -> str | None:
        return f"{self.location}/{table.replace('.', '/')}" if self.location else None

    def create(self, spark: SparkSession) -> None:
        for schema in (self.raw, self.staging, self.marts):
            create_schema(spark, schema)
        create_matches_table(spark, self.matches, self.path(self.matches))


@dataclass(frozen=True)
class RunReport:
    """Results of a run; frames are lazy reads of what was written."""

    profile: DataFrame
    coverage: DataFrame
    counts: StagedCounts
    load: DataFrame
    league_table: DataFrame
    match_kpi: DataFrame
    quality: DataFrame
    gates: DataFrame


def profile_source(
    spark: SparkSession,
    source: str,
    seasons: str | Iterable[str] | None,
    summary_path: str,
    **reading,
) -> tuple[DataFrame, DataFrame]:
    """Profile summary and season coverage; warns about configured seasons without matches.

    The summary is written once, so that every report on it reads a small file
    instead of the source. ``reading`` are options of the CSV reader; ``multiLine=True``
    accepts line breaks inside quoted fields, but no longer splits a file.
    """
    raw = read_raw_text(spark, source, **reading)
    summary = settled(summarise(raw), raw, summary_path)
    coverage = season_coverage(summary, [] if seasons is None else seasons)
    missing = [row["season"] for row in coverage.where(~F.col("found")).collect()]
    if missing:
        warnings.warn(f"missing seasons: {missing}", stacklevel=2)
    return summary, coverage


def stage_source(
    spark: SparkSession,
    source: str,
    seasons: str | Iterable[str] | None,
    staged_path: str,
    ingested_at: datetime | None = None,
    **reading,
) -> StagedCounts:
    """Raw CSV to staged Parquet in one scan; warns about dropped rows."""
    raw = read_raw(spark, source, **reading)
    counts = stage_and_write(raw, seasons, staged_path, ingested_at)
    if counts.rows_dropped:
        warnings.warn(f"dropped {counts.rows_dropped} incomplete rows", stacklevel=2)
    return counts


def load_matches(spark: SparkSession, staged_path: str, schemas: Schemas) -> DataFrame:
    """Staged Parquet into the typed table; returns the verification row, from its summary."""
    staged = require_rows(read_staged(spark, staged_path), staged_path)
    schemas.create(spark)
    reload_matches(staged, schemas.matches, balanced=True)
    return verify_version(spark, schemas.matches)


def materialise_models(
    spark: SparkSession,
    schemas: Schemas,
    marts: Iterable[str] = tuple(MARTS),
    checks: WriteChecks | None = None,
) -> dict[str, DataFrame]:
    """Views for the two lower models, tables for the marts; returns all as read back.

    ``checks`` watches the rows that the marts are made of while they are written.
    """
    schemas.create(spark)
    require_rows(read_table(spark, schemas.matches), schemas.matches)
    views = create_model_views(spark, schemas.raw, schemas.staging)
    lower = {name: read_table(spark, view) for name, view in views.items()}
    built = {}
    for name in marts:
        table = f"{schemas.marts}.{name}"
        mart = build_mart(name, lower, checks)
        save_mart(mart, table, schemas.path(table), CLUSTERED.get(name))
        built[name] = read_table(spark, table)
    return lower | built


def check_models(
    spark: SparkSession,
    models: dict[str, DataFrame],
    report_path: str,
    severity: str = "warn",
    checks: WriteChecks | None = None,
) -> DataFrame:
    """The checks of all models; written once, so that reading the report scans no model again.

    ``checks`` that watched the marts being written have counted already.
    """
    report = checks.report(models) if checks else quality_report(models)
    report.write.mode("overwrite").parquet(report_path)
    return enforce(spark.read.parquet(report_path), severity)


def gates(
    spark: SparkSession,
    source: str,
    coverage: DataFrame,
    counts: StagedCounts,
    load: DataFrame,
    **reading,
) -> DataFrame:
    """The run's own checks as report rows: header, seasons, load count, rows at all."""
    return (
        header_report(header(spark, source, **reading), RAW_COLUMNS, coverage)
        .unionByName(coverage_report(coverage))
        .unionByName(load_report(load, counts.rows_kept))
    )


def run(
    spark: SparkSession,
    source: str,
    seasons: str | Iterable[str] | None,
    work_dir: str,
    schemas: Schemas = Schemas(),
    severity: str = "warn",
    ingested_at: datetime | None = None,
    **reading,
) -> RunReport:
    """All steps over one source; ``work_dir`` is a folder that all executors share."""
    seasons = seasons if seasons is None or isinstance(seasons, str) else list(seasons)
    summary, coverage = profile_source(spark, source, seasons, f"{work_dir}/profile", **reading)
    counts = stage_source(spark, source, seasons, f"{work_dir}/staged", ingested_at, **reading)
    load = load_matches(spark, f"{work_dir}/staged", schemas)
    gate_rows = gates(spark, source, coverage, counts, load, **reading)
    checks = WriteChecks()
    models = materialise_models(spark, schemas, checks=checks)
    quality = check_models(spark, models, f"{work_dir}/quality", severity, checks)
    return RunReport(
        profile=summary,
        coverage=coverage,
        counts=counts,
        load=load,
        league_table=models["fct_league_table"].orderBy("season", "season_rank"),
        match_kpi=models["fct_match_kpi"],
        quality=quality,
        gates=gate_rows,
    )
