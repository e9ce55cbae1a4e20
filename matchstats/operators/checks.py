"""Column checks with one report row per check."""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    column: str
    name = "not_null"

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    """Null passes; only a present value outside the list fails."""

    column: str
    values: tuple[str, ...]
    name = "accepted_values"

    def failing(self) -> Column:
        return ~F.col(self.column).isin(list(self.values))


@dataclass(frozen=True)
class Unique:
    """Counts the values that occur more than once; nulls do not take part."""

    column: str
    name = "unique"


# The checks of each model.
MODEL_CHECKS = {
    "stg_matches": (
        NotNull("match_date"),
        NotNull("home_team"),
        NotNull("away_team"),
        NotNull("result"),
        AcceptedValues("result", ("H", "A", "D")),
    ),
    "int_team_stats": (NotNull("team"), NotNull("season")),
    "fct_league_table": (
        NotNull("team"),
        NotNull("season"),
        NotNull("points"),
        NotNull("season_rank"),
    ),
    "fct_match_kpi": (NotNull("season"), Unique("season"), NotNull("avg_goals_per_match")),
}


#: The columns of every report.
REPORT_SCHEMA = "model string, check string, column string, failures long, passed boolean"


class QualityError(ValueError):
    """A check failed under severity ``error``."""


def _report(counts: DataFrame, model: str, counted: dict) -> DataFrame:
    """One row per check from a one-row frame; ``counted`` names each check's column in it."""
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(check.name).alias("check"),
            F.lit(check.column).alias("column"),
            F.coalesce(F.col(n), F.lit(0)).alias("failures"),
            (F.coalesce(F.col(n), F.lit(0)) == 0).alias("passed"),
        )
        for n, check in counted.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def check_model(frame: DataFrame, model: str, checks=None) -> DataFrame:
    """(model, check, column, failures, passed) for one model.

    All row checks share one aggregation. A uniqueness check groups by its column
    first, and the row checks ride along with the first of those, so a model with at
    most one unique column is scanned once.
    """
    checks = MODEL_CHECKS[model] if checks is None else checks
    row_checks = {f"n{i}": c for i, c in enumerate(checks) if not isinstance(c, Unique)}
    unique_checks = [c for c in checks if isinstance(c, Unique)]
    failing = [F.count_if(check.failing()).alias(n) for n, check in row_checks.items()]
    if not unique_checks:
        return _report(frame.agg(*failing), model, row_checks)
    reports = []
    for check in unique_checks:
        value = F.col(check.column)
        counts = (
            frame.groupBy(value.alias("value"))
            .agg(F.count("*").alias("occurrences"), *failing)
            .agg(
                F.count_if(F.col("value").isNotNull() & (F.col("occurrences") > 1)).alias("repeated"),
                *[F.sum(n).alias(n) for n in row_checks],
            )
        )
        reports.append(_report(counts, model, {**row_checks, "repeated": check}))
        row_checks, failing = {}, []
    return reduce(DataFrame.unionByName, reports)


def quality_report(models: dict[str, DataFrame]) -> DataFrame:
    """The reports of all given models under one another."""
    return reduce(DataFrame.unionByName, [check_model(f, m) for m, f in models.items()])


def row_tests(model: str) -> dict[str, Column]:
    """A column name and a test of failing rows for each row check of a model."""
    checks = enumerate(MODEL_CHECKS[model])
    return {f"failing_{i}": c.failing() for i, c in checks if not isinstance(c, Unique)}


def failures_report(spark: SparkSession, failures: dict[str, list[int]]) -> DataFrame:
    """The report of models whose failures are counted, in the order of their checks."""
    rows = [
        (model, check.name, check.column, int(n), n == 0)
        for model, counts in failures.items()
        for check, n in zip(MODEL_CHECKS[model], counts, strict=True)
    ]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def gate(model: str, check: str, column: str, failures: Column | int) -> Column:
    """One report row of a run's own checks."""
    failures = F.coalesce(F.lit(failures) if isinstance(failures, int) else failures, F.lit(0))
    failures = failures.cast("long")
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        failures.alias("failures"),
        (failures == 0).alias("passed"),
    )


def header_report(columns: list[str], required: list[str], like: DataFrame) -> DataFrame:
    """Is each required column in the header; ``like`` lends its session."""
    rows = [gate("raw", "required_column", c, int(c not in columns)) for c in required]
    return like.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def coverage_report(coverage: DataFrame) -> DataFrame:
    """Does each configured season have matches."""
    return coverage.select(
        F.lit("raw").alias("model"),
        F.lit("season_coverage").alias("check"),
        F.col("season").alias("column"),
        (~F.col("found")).cast("long").alias("failures"),
        F.col("found").alias("passed"),
    )


def load_report(verified: DataFrame, rows_staged: int) -> DataFrame:
    """Does the table hold the staged rows, and any at all."""
    loaded = F.col("rows_loaded")
    return verified.select(
        F.inline(
            F.array(
                gate("matches", "load_count", "rows", F.abs(loaded - rows_staged)),
                gate("matches", "not_empty", "rows", (loaded == 0).cast("long")),
            )
        )
    )


def enforce(report: DataFrame, severity: str = "warn") -> DataFrame:
    """Warn about failed checks, or raise under severity ``error``; returns the report.

    Fetches failed rows only, at most one per declared check.
    """
    if severity not in ("warn", "error"):
        raise ValueError(f"severity must be 'warn' or 'error', not {severity!r}")
    failed = [
        f"{row['model']}.{row['column']} {row['check']}: {row['failures']} failures"
        for row in report.where(~F.col("passed")).collect()
    ]
    if failed and severity == "error":
        raise QualityError("; ".join(failed))
    if failed:
        warnings.warn("failed checks: " + "; ".join(failed), stacklevel=2)
    return report
