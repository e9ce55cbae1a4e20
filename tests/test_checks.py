from __future__ import annotations

import pytest

from matchstats.operators.checks import (
    MODEL_CHECKS,
    AcceptedValues,
    NotNull,
    QualityError,
    Unique,
    check_model,
    enforce,
    quality_report,
)


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [("a", "H"), ("a", "X"), ("b", None), (None, "D"), (None, "A"), ("c", "Y")], "k string, r string"
    )


def failures(report):
    return {(r["check"], r["column"]): (r["failures"], r["passed"]) for r in report.collect()}


def test_failures_are_counted(frame):
    checks = [NotNull("k"), NotNull("r"), AcceptedValues("r", ("H", "A", "D")), Unique("k"), Unique("r")]
    assert failures(check_model(frame, "m", checks)) == {
        ("not_null", "k"): (2, False),
        ("not_null", "r"): (1, False),
        ("accepted_values", "r"): (2, False),
        ("unique", "k"): (1, False),
        ("unique", "r"): (0, True),
    }


def test_checks_of_an_empty_frame_pass(frame):
    empty = frame.where("false")
    assert set(failures(check_model(empty, "m", [NotNull("k"), Unique("k")])).values()) == {(0, True)}
    assert failures(check_model(empty, "m", [NotNull("k")])) == {("not_null", "k"): (0, True)}


def test_fourteen_checks_are_declared():
    assert sum(len(checks) for checks in MODEL_CHECKS.values()) == 14


def test_severity(frame):
    bad = check_model(frame, "m", [NotNull("k")])
    with pytest.warns(UserWarning, match="m.k not_null: 2 failures"):
        enforce(bad)
    with pytest.raises(QualityError, match="m.k not_null: 2 failures"):
        enforce(bad, "error")
    with pytest.raises(ValueError, match="severity"):
        enforce(bad, "loud")
    good = check_model(frame.where("k is not null"), "m", [NotNull("k")])
    assert enforce(good, "error") is good


def test_report_covers_all_models(spark):
    nulls = spark.sql(
        "SELECT cast(null as string) AS season, cast(null as string) AS team, null AS points, "
        "null AS season_rank, null AS avg_goals_per_match, null AS match_date, null AS home_team, "
        "null AS away_team, cast(null as string) AS result"
    )
    report = failures_by_model(quality_report({m: nulls for m in MODEL_CHECKS}))
    assert report == {"stg_matches": 4, "int_team_stats": 2, "fct_league_table": 4, "fct_match_kpi": 2}


def failures_by_model(report):
    counts = {}
    for r in report.collect():
        counts[r["model"]] = counts.get(r["model"], 0) + r["failures"]
    return counts
