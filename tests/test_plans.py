"""Physical plans: what reaches the scan, how many scans and shuffles, what stays out."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as registered
from matchstats.operators.insights import champions
from matchstats.operators.kpi import match_kpi
from matchstats.operators.league import league_table
from matchstats.operators.matches import match_facts, stg_matches
from matchstats.operators.profile import profile_totals, summarise
from matchstats.operators.staging import stage_matches
from matchstats.operators.team_stats import team_stats
from matchstats.sinks.staged import write_staged
from matchstats.sources.fixture import FIXTURE_SEASONS, read_fixture
from matchstats.sources.raw_csv import read_raw_text
from matchstats.sources.staged import read_staged

SF_DIR = "/root/testdata/sf0.001"
# Queries that write first; what is left of them reads that.
WRITING = {
    "csv_roundtrip", "parquet_roundtrip", "staged_season_scan", "table_reload",
    "load_verification", "views_and_marts", "kpi_mart", "team_stats_view", "dropped_rows",
    "run_gates", "table_date_range", "stg_matches_text_dates", "quality_report",
    "profile_totals", "failing_gates", "faulty_checks", "text_totals", "text_seasons", "text_blanks", "text_malformed",
}
MATCHES = {n for n in registered.queries() if n != "pipeline" and not n.startswith("op")}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "staged")
    write_staged(stage_matches(read_fixture(spark, SF_DIR), FIXTURE_SEASONS), path)
    return path


@pytest.mark.parametrize("name", sorted(MATCHES - WRITING))
def test_no_pair_joins_no_python_no_extra_scans(spark, name):
    text = plan(registered.queries()[name](spark, SF_DIR))
    for operator in ("Cartesian", "NestedLoop", "Join", "PythonEval", "ArrowEval", "MapInPandas"):
        assert operator not in text
    assert text.count("FileScan") == 1
    for columns in re.findall(r"FileScan parquet \[(.*?)\]", text):
        assert set(re.sub(r"#\d+L?", "", columns).split(",")) <= {"o_orderkey", "o_custkey", "o_orderdate"}


def test_null_tests_reach_the_scan(spark, staged_path):
    text = plan(stg_matches(read_staged(spark, staged_path)))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    for column in ("match_date", "home_team", "away_team", "home_goals", "away_goals"):
        assert f"IsNotNull({column})" in pushed


def test_season_list_prunes_directories(spark, staged_path):
    scanned = read_staged(spark, staged_path, ["1996/97", "1999"])
    filters = re.search(r"PartitionFilters: \[(.*?)\]", plan(scanned)).group(1)
    assert "1996" in filters and "1999" in filters


def test_totals_take_one_scan_and_no_sort(spark):
    """Unreadable dates too: they are compared as numbers in the same hash aggregate."""
    raw = read_fixture(spark, SF_DIR)
    text = plan(summarise(raw).agg({"low_code": "min", "high_code": "max", "matches": "sum"}))
    assert text.count("FileScan") == 1 and "SortAggregate" not in text and "Sort [" not in text


def test_columns_are_pruned(spark, staged_path):
    stg = stg_matches(read_staged(spark, staged_path))
    league = plan(league_table(team_stats(stg)))
    for unused in ("corners", "fouls", "ht_", "ingested_at"):
        assert unused not in league
    kpi = plan(match_kpi(match_facts(stg)))
    for unused in ("yellow", "fouls", "home_points", "ingested_at"):
        assert unused not in kpi


def test_league_aggregates_before_it_shuffles(spark, staged_path):
    text = plan(league_table(team_stats(stg_matches(read_staged(spark, staged_path)))))
    assert text.count("FileScan") == 1
    assert text.count("Exchange ") == 3
    # The lowest of the three: match rows are summed before any of them moves.
    assert text.rindex("partial_sum") > text.rindex("Exchange ")
    assert "SortAggregate" not in text


def test_top_k_is_limited_before_the_shuffle_of_the_window(spark, staged_path):
    text = plan(champions(league_table(team_stats(stg_matches(read_staged(spark, staged_path))))))
    assert "WindowGroupLimit" in text


def test_profile_does_not_sort_rows(spark, raw):
    text = plan(summarise(raw({})))
    assert not re.search(r"\bSort \[", text)
    assert "HashAggregate" in text


def test_profile_summary_stays_small_on_dirty_dates(spark, raw):
    """A time of day after every date makes no group of its own."""
    dates = [{"MatchDate": f"2015-08-08 {h:02d}:{m:02d}"} for h in range(24) for m in range(5)]
    rows = raw({}, *dates)
    summary = summarise(rows)
    assert summary.count() == 1
    assert tuple(profile_totals(summary, rows).first()) == (121, 1, "2015-08-08", "2015-08-08 23:04")


@pytest.mark.parametrize("name", ["summarise", "team_stats", "kpi", "stage"])
def test_generated_methods_are_small_enough_to_be_compiled(spark, staged_path, tmp_path, name):
    """The JVM never compiles a method over 8,000 bytes of bytecode."""
    from matchstats.sinks.raw_csv import write_raw

    raw = read_fixture(spark, SF_DIR)
    if name == "summarise":
        write_raw(raw, str(tmp_path / "raw"))
        frame = summarise(read_raw_text(spark, str(tmp_path / "raw")))
    elif name == "stage":
        frame = stage_matches(raw, FIXTURE_SEASONS)
    else:
        stg = stg_matches(read_staged(spark, staged_path))
        frame = team_stats(stg) if name == "team_stats" else match_kpi(match_facts(stg))
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = getattr(debug, "package").codegenString(frame.select("*")._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
