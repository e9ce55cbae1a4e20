"""Command line: ``python -m matchstats <step> ...`` or the same under spark-submit.

The session comes from the environment it runs in; results are printed as tables.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .functions.seasons import DEFAULT_SEASONS
from .operators.profile import covered_matches, profile_blanks, profile_frequency, profile_totals
from .operators.staging import rows_per_season, sample_rows
from .plans.full_run import (
    Schemas,
    check_models,
    load_matches,
    materialise_models,
    profile_source,
    run,
    stage_source,
)
from .plans.models import WriteChecks
from .sources.staged import read_staged


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="matchstats", description=__doc__)
    parser.add_argument("step", choices=["profile", "stage", "load", "model", "run"])
    parser.add_argument("--source", help="raw CSV file or folder (profile, stage, run)")
    parser.add_argument("--work-dir", required=True, help="shared folder for staged data")
    parser.add_argument(
        "--seasons",
        default=os.environ.get("SEASONS", ",".join(DEFAULT_SEASONS)),
        help="comma-separated labels (2015/16) or start years (2015)",
    )
    parser.add_argument("--all-seasons", action="store_true", help="every season in the source")
    parser.add_argument(
        "--reading", action="append", default=[], metavar="OPTION=VALUE",
        help="option of the CSV reader, such as sep=; or multiLine=true; may be repeated",
    )
    parser.add_argument("--raw-schema", default="raw")
    parser.add_argument("--staging-schema", default="staging")
    parser.add_argument("--marts-schema", default="marts")
    parser.add_argument("--severity", choices=["warn", "error"], default="warn")
    return parser


def _show(title: str, frame: DataFrame) -> None:
    """Prints a report whole; the reports hold a row per season, column or check."""
    print(title)
    frame.show(max(1, frame.count()), truncate=False)


def _show_profile(summary: DataFrame, coverage: DataFrame, seasons: str | None) -> None:
    _show("Totals", profile_totals(summary))
    _show("Results", profile_frequency(summary, "result"))
    _show("Configured seasons", coverage)
    _show("Matches of configured seasons", covered_matches(summary, seasons))
    _show("Blank values", profile_blanks(summary).where("blanks > 0"))


def _show_staged(staged: DataFrame) -> None:
    _show("Staged rows by season", rows_per_season(staged))
    _show("Sample", sample_rows(staged, ordered=False))


def main(arguments: Sequence[str] | None = None) -> None:
    parser = _parser()
    options = parser.parse_args(arguments)
    if options.step in ("profile", "stage", "run") and not options.source:
        parser.error(f"{options.step} needs --source")
    spark = SparkSession.builder.appName("matchstats").getOrCreate()
    work_dir = options.work_dir if ":" in options.work_dir else os.path.abspath(options.work_dir)
    schemas = Schemas(
        options.raw_schema, options.staging_schema, options.marts_schema, f"{work_dir}/tables"
    )
    staged_path, profile_path = f"{work_dir}/staged", f"{work_dir}/profile"
    seasons = None if options.all_seasons else options.seasons
    reading = dict(option.split("=", 1) for option in options.reading)

    if options.step == "profile":
        _show_profile(
            *profile_source(spark, options.source, seasons, profile_path, **reading), seasons
        )
    elif options.step == "stage":
        print(stage_source(spark, options.source, seasons, staged_path, **reading))
        _show_staged(read_staged(spark, staged_path))
    elif options.step == "load":
        _show("Loaded", load_matches(spark, staged_path, schemas))
    elif options.step == "model":
        checks = WriteChecks()
        models = materialise_models(spark, schemas, checks=checks)
        quality = check_models(spark, models, f"{work_dir}/quality", options.severity, checks)
        _show("Checks", quality)
    else:
        report = run(
            spark, options.source, seasons, work_dir, schemas, options.severity, **reading
        )
        _show_profile(report.profile, report.coverage, seasons)
        _show_staged(read_staged(spark, staged_path))
        _show("Loaded", report.load)
        _show("Gates", report.gates)
        _show("Checks", report.quality)


if __name__ == "__main__":
    main()
