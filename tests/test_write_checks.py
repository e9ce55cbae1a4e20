"""Checks observed while marts are written."""

from __future__ import annotations

import pytest

import matchstats.plans.models as models
from matchstats.operators.checks import quality_report
from matchstats.operators.staging import stage_matches
from matchstats.plans.models import WriteChecks, build_models, check_all


@pytest.fixture
def faulty(raw):
    results = ["H", None, "X", "A", None, "D"]
    return stage_matches(raw(*[{"FullTimeResult": r, "Season": f"201{k}/1{k + 1}"} for k, r in enumerate(results)]))


def rows(report):
    return sorted(tuple(r) for r in report.collect())


def test_report_equals_the_checks_of_the_models(faulty):
    report = check_all(faulty)
    expected = quality_report(build_models(faulty))
    assert rows(report) == rows(expected) and report.dtypes == expected.dtypes
    failures = {r[:3]: r[3] for r in rows(report) if not r[4]}
    assert failures == {("stg_matches", "not_null", "result"): 2, ("stg_matches", "accepted_values", "result"): 1}


def test_no_rows_at_all(raw):
    report = rows(check_all(stage_matches(raw({}), [])))
    assert len(report) == 14 and all(r[3] == 0 and r[4] for r in report)


def test_values_that_occur_twice(spark):
    checks = WriteChecks()
    frame = spark.createDataFrame(
        [("a", 1.0, 1), ("a", None, 1), ("b", 2.0, 1), (None, 1.0, 1), (None, 1.0, 1)],
        "season string, avg_goals_per_match double, total_matches long",
    )
    checks.watch(frame, "fct_match_kpi").collect()
    found = models.observed(checks._seen["fct_match_kpi"])
    assert checks._failures("fct_match_kpi", found) == [2, 1, 1]


def test_rows_observed_twice_are_counted_anew(faulty, monkeypatch):
    """As after an executor was lost: more was seen than the marts hold."""
    seen = models.observed
    monkeypatch.setattr(models, "observed", lambda o: {k: v * 2 for k, v in seen(o).items()})
    assert rows(check_all(faulty)) == rows(quality_report(build_models(faulty)))


def test_checks_of_a_run_read_marts_only(spark, faulty):
    """Two small sums over what was written; no match is read again."""
    checks = WriteChecks()
    marts = build_models(faulty)
    lower = {m: marts[m] for m in ("stg_matches", "int_team_stats")}
    built = {}
    for name in models.MARTS:
        frame = models.build_mart(name, lower, checks).collect()
        built[name] = spark.createDataFrame(frame, marts[name].schema)
    report = checks.report(built)
    assert rows(report) == rows(quality_report(marts))
