from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchstats.functions.ratios import percentage, ratio
from matchstats.operators.insights import champions, home_win_change, top_teams
from matchstats.operators.kpi import match_kpi
from matchstats.operators.league import LEAGUE_COLUMNS, league_table
from matchstats.operators.matches import match_facts, stg_matches
from matchstats.operators.staging import stage_matches
from matchstats.operators.team_stats import (
    SIDE_MEASURES,
    TEAM_STATS_COLUMNS,
    away_stats,
    home_stats,
    team_stats,
)
from matchstats.sources.fixture import FIXTURE_SEASONS, read_fixture

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stg(spark):
    return stg_matches(stage_matches(read_fixture(spark, SF_DIR), FIXTURE_SEASONS)).cache()


def table(frame):
    return sorted(map(str, frame.collect()))


def test_team_stats_is_home_plus_away(stg):
    stats = team_stats(stg)
    assert stats.columns == TEAM_STATS_COLUMNS
    assert table(stats) == table(home_stats(stg).unionByName(away_stats(stg)))


def test_team_stats_against_plain_python(stg):
    expected = defaultdict(lambda: defaultdict(int))
    for row in stg.collect():
        for venue, team, side in (("home", row["home_team"], 1), ("away", row["away_team"], 2)):
            group = expected[(row["season"], row["season_start_year"], team, venue)]
            group["matches_played"] += 1
            for measure in SIDE_MEASURES:
                group[measure[0]] += row[measure[side]] or 0
            group["goal_difference"] = group["goals_scored"] - group["goals_conceded"]
    actual = {tuple(r)[:4]: r.asDict() for r in team_stats(stg).collect()}
    assert set(actual) == set(expected)
    for key, group in expected.items():
        assert {name: actual[key][name] for name in group} == dict(group)


def test_league_invariants(stg):
    league = league_table(team_stats(stg)).collect()
    facts = stg.groupBy("season").agg(F.count("*").alias("n"), F.sum("draw").alias("draws"))
    for season, n, draws in facts.collect():
        rows = [r for r in league if r["season"] == season]
        assert sum(r["points"] for r in rows) == 3 * (n - draws) + 2 * draws
        assert sum(r["goal_difference"] for r in rows) == 0
        assert sum(r["matches_played"] for r in rows) == 2 * n
        assert [r["season_rank"] for r in rows] == list(range(1, len(rows) + 1))
        assert sum(r["top_4"] for r in rows) == 4
        assert sum(r["relegated"] for r in rows) == len(rows) - 17
        for r in rows:
            assert r["wins"] + r["draws"] + r["losses"] == r["matches_played"]


def test_kpi_invariants(stg):
    for r in match_kpi(match_facts(stg)).collect():
        assert r["home_wins"] + r["away_wins"] + r["draws"] == r["total_matches"]
        assert abs(r["home_win_pct"] + r["away_win_pct"] + r["draw_pct"] - 100) <= 0.15


def stats_rows(spark, *rows):
    """Team stats with one home row per (team, points, goal difference, goals scored)."""
    built = [
        ("2015/16", 2015, team, "home", 38, 10, 8, 20, goals, goals - diff, diff, points)
        + (100, 40, 50, 2, 150, 300)
        for team, points, diff, goals in rows
    ]
    return spark.createDataFrame(
        built,
        "season string, season_start_year int, team string, venue string, "
        + ", ".join(f"{c} long" for c in TEAM_STATS_COLUMNS[4:]),
    )


def test_rank_order_and_ties(spark):
    stats = stats_rows(
        spark,
        ("twin b", 50, 5, 40), ("twin a", 50, 5, 40), ("more goals", 50, 5, 41),
        ("better difference", 50, 6, 30), ("fewest points", 49, 90, 99), ("most points", 51, -9, 10),
    )
    ranked = league_table(stats, top_ranks=2, relegated_from=6)
    assert ranked.columns == LEAGUE_COLUMNS
    rows = ranked.collect()
    assert [r["team"] for r in rows] == [
        "most points", "better difference", "more goals", "twin a", "twin b", "fewest points",
    ]
    assert [r["top_4"] for r in rows] == [True, True] + [False] * 4
    assert [r["relegated"] for r in rows] == [False] * 5 + [True]
    assert [r["team"] for r in champions(ranked, 2).collect()] == ["most points", "better difference"]
    assert [r["team"] for r in top_teams(ranked, 2).collect()] == ["most points", "better difference"]


def test_zero_denominators_give_null(spark, raw):
    rows = raw({"HomeShots": 0, "HomeShotsOnTarget": 0, "HalfTimeHomeGoals": None})
    stg = stg_matches(stage_matches(rows, ["2015/16"]))
    kpi = match_kpi(match_facts(stg)).first()
    assert kpi["home_advantage_index"] is None
    assert kpi["avg_ht_goals"] is None
    assert kpi["home_win_pct"] == 100.0
    home = league_table(team_stats(stg)).where("team = 'A'").first()
    assert home["shot_accuracy_pct"] is None


def test_unknown_result_counts_as_played(raw):
    stg = stg_matches(stage_matches(raw({"FullTimeResult": None}), ["2015/16"]))
    for r in league_table(team_stats(stg)).collect():
        assert (r["matches_played"], r["wins"], r["draws"], r["losses"], r["points"]) == (1, 0, 0, 0, 0)


def test_rounding_is_half_up(spark):
    pairs = spark.range(0, 301).selectExpr("id AS b").where("b > 0").selectExpr(
        "b", "explode(sequence(0L, b)) AS a"
    )
    rows = pairs.select(
        "a", "b",
        percentage(F.col("a"), F.col("b")).alias("pct"),
        ratio(F.col("a"), F.col("b")).alias("ratio"),
    ).collect()
    for a, b, pct, rat in rows:
        exact = Decimal(a) / Decimal(b)
        assert pct == float((exact * 100).quantize(Decimal("0.1"), ROUND_HALF_UP))
        assert rat == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_home_win_change_settles_ties_by_the_earlier_season(spark):
    kpi = spark.createDataFrame(
        [("2016/17", 2016, 40.0), ("2015/16", 2015, 49.5), ("2018/19", 2018, 41.2), ("2017/18", 2017, 40.0)],
        "season string, season_start_year int, home_win_pct double",
    )
    assert tuple(home_win_change(kpi).first()) == (
        "2015/16", 49.5, "2018/19", 41.2, -8.3, "2016/17", 40.0,
    )


scores = st.lists(
    st.tuples(
        st.sampled_from(["2015/16", "2016/17"]), st.integers(0, 5), st.integers(1, 4),
        st.integers(0, 6), st.integers(0, 6),
    ),
    min_size=1,
    max_size=40,
)


@given(scores)
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_results_give_a_consistent_table(raw, drawn):
    names = "ABCDEF"
    rows = raw(
        *[
            {
                "Season": season, "HomeTeam": names[h], "AwayTeam": names[(h + step) % 6],
                "FullTimeHomeGoals": hg, "FullTimeAwayGoals": ag,
                "FullTimeResult": "H" if hg > ag else "A" if hg < ag else "D",
            }
            for season, h, step, hg, ag in drawn
        ]
    )
    points, difference = defaultdict(int), defaultdict(int)
    for season, h, step, hg, ag in drawn:
        home, away = (season, names[h]), (season, names[(h + step) % 6])
        points[home] += 3 * (hg > ag) + (hg == ag)
        points[away] += 3 * (ag > hg) + (hg == ag)
        difference[home] += hg - ag
        difference[away] += ag - hg
    league = league_table(team_stats(stg_matches(stage_matches(rows, "2015,2016")))).collect()
    assert {(r["season"], r["team"]): r["points"] for r in league} == dict(points)
    assert {(r["season"], r["team"]): r["goal_difference"] for r in league} == dict(difference)
