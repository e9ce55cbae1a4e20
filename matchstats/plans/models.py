"""The model graph: typed matches -> cleaned matches -> team stats -> marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.checks import MODEL_CHECKS, Unique, failures_report, quality_report, row_tests
from ..operators.kpi import match_kpi
from ..operators.league import league_table
from ..operators.matches import match_facts, stg_matches
from ..operators.team_stats import team_stats
from ..session import scratch_dir
from ..sinks.layout import Clustering
from ..sinks.staged import observed

#: The mart and the lower model it is made from.
MARTS = {
    "fct_league_table": ("int_team_stats", league_table),
    "fct_match_kpi": ("stg_matches", lambda stg: match_kpi(match_facts(stg))),
}
#: How marts are clustered that are asked by season.
CLUSTERED = {"fct_league_table": Clustering("season", ("season", "season_rank"))}
#: A match is so many units of a model's column of matches (none: of its rows).
_MATCHES = {
    "stg_matches": (None, 1),
    "int_team_stats": ("matches_played", 2),
    "fct_league_table": ("matches_played", 2),
    "fct_match_kpi": ("total_matches", 1),
}


def build_models(matches: DataFrame) -> dict[str, DataFrame]:
    """All four models as lazy frames over one match table."""
    stg = stg_matches(matches)
    lower = {"stg_matches": stg, "int_team_stats": team_stats(stg)}
    return lower | {name: build_mart(name, lower) for name in MARTS}


class WriteChecks:
    """Counts of failing rows, observed while marts are written, so that checks cost no scan.

    A mart's own rows are counted as they are written, and the rows of the model below it as
    they are read for it. Tasks that run again are observed again; so each model's matches,
    which are observed too, are held against those of the marts as read back, and where they
    differ the checks are counted anew by reading the models.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, frame: DataFrame, model: str) -> DataFrame:
        """The same rows. A column checked for repeated values has few: one a season."""
        column, _ = _MATCHES[model]
        unique = [c for c in MODEL_CHECKS[model] if isinstance(c, Unique)]
        seen = self._seen[model] = Observation()
        return frame.observe(
            seen,
            (F.sum(column) if column else F.count(F.lit(1))).alias("matches"),
            *[F.count_if(test).alias(name) for name, test in row_tests(model).items()],
            *[F.collect_list(c.column).alias(f"values_{c.column}") for c in unique],
        )

    def _failures(self, model: str, values: dict) -> list[int]:
        counts, held = [], iter(row_tests(model))
        for check in MODEL_CHECKS[model]:
            if isinstance(check, Unique):
                found = list(values[f"values_{check.column}"])
                counts.append(sum(found.count(v) > 1 for v in set(found)))
            else:
                counts.append(values[next(held)])
        return counts

    def report(self, models: dict[str, DataFrame]) -> DataFrame:
        """(model, check, column, failures, passed) of the watched models, all in ``models``."""
        spark = next(iter(models.values())).sparkSession
        values = {model: observed(seen) for model, seen in self._seen.items()}
        matches = {}
        for mart, (below, _) in MARTS.items():
            if mart in values:
                column, share = _MATCHES[mart]
                matches[mart] = matches[below] = (models[mart].agg(F.sum(column)).first()[0] or 0) / share
        for model, seen in values.items():
            if not seen or (seen["matches"] or 0) / _MATCHES[model][1] != matches[model]:
                return quality_report({m: models[m] for m in MODEL_CHECKS if m in values})
        rows = {m: self._failures(m, values[m]) for m in MODEL_CHECKS if m in values}
        return failures_report(spark, rows)


def build_mart(name: str, lower: dict[str, DataFrame], checks: WriteChecks | None = None) -> DataFrame:
    below, build = MARTS[name]
    if checks is None:
        return build(lower[below])
    return checks.watch(build(checks.watch(lower[below], below)), name)


def check_all(matches: DataFrame) -> DataFrame:
    """The checks of all four models over one match table, in two scans of it.

    Both marts are written once, and everything is counted on the way.
    """
    spark = matches.sparkSession
    stg = stg_matches(matches)
    models = {"stg_matches": stg, "int_team_stats": team_stats(stg)}
    checks = WriteChecks()
    for name in MARTS:
        path = scratch_dir(spark, name)
        build_mart(name, models, checks).write.parquet(path)
        models[name] = spark.read.parquet(path)
    return checks.report(models)
