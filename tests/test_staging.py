from __future__ import annotations

from datetime import date, datetime

import pytest

from matchstats.functions.seasons import parse_seasons
from matchstats.operators.matches import match_facts, stg_matches
from matchstats.operators.staging import (
    clean_and_enrich,
    count_staged,
    drop_incomplete,
    filter_seasons,
    rows_per_season,
    sample_rows,
    stage_matches,
)
from matchstats.schemas import STAGED_COLUMNS, STAGED_SCHEMA


def seasons_of(frame):
    return sorted(r["Season"] for r in frame.collect())


@pytest.fixture
def many_seasons(raw):
    labels = ["2015/16", "2016/17", "2017/18", "2015/15", "2015", None, "", "20151/16"]
    return raw(*[{"Season": s} for s in labels])


@pytest.mark.parametrize(
    ("listed", "kept"),
    [
        (["2015/16", "2017/18"], ["2015/16", "2017/18"]),
        (["2015"], ["2015", "2015/15", "2015/16"]),
        ([" 2016/17 ", "2015 ", "", "  "], ["2015", "2015/15", "2015/16", "2016/17"]),
        ("2016/17, 2017", ["2016/17", "2017/18"]),
        (["1999/00"], []),
        ([], []),
        ("", []),
        (None, ["", "2015", "2015/15", "2015/16", "20151/16", "2016/17", "2017/18"]),
    ],
)
def test_season_filter(many_seasons, listed, kept):
    assert seasons_of(filter_seasons(many_seasons, listed)) == kept


def test_parse_seasons_trims_and_removes_repeats():
    assert parse_seasons(" 2015/16,2016,, 2015/16 ") == ["2015/16", "2016"]


def test_enriched_schema_and_types(raw):
    enriched = clean_and_enrich(raw({}))
    assert enriched.columns == STAGED_COLUMNS
    assert dict(enriched.dtypes) == {f.name: f.dataType.simpleString() for f in STAGED_SCHEMA}


@pytest.mark.parametrize(
    ("result", "flags", "points"),
    [
        ("H", (1, 0, 0), (3, 0)),
        ("A", (0, 1, 0), (0, 3)),
        ("D", (0, 0, 1), (1, 1)),
        (None, (0, 0, 0), (0, 0)),
        ("X", (0, 0, 0), (0, 0)),
    ],
)
def test_result_flags_and_points(raw, result, flags, points):
    row = stage_matches(raw({"FullTimeResult": result}), ["2015/16"]).first()
    assert (row["home_win"], row["away_win"], row["draw"]) == flags
    assert (row["home_points"], row["away_points"]) == points
    assert row["result"] == result


def test_malformed_dates_and_seasons_become_null(raw):
    source = raw(
        {"HomeTeam": "ok"},
        {"HomeTeam": "slashes", "MatchDate": "08/08/2015"},
        {"HomeTeam": "no such day", "MatchDate": "2015-02-30"},
        {"HomeTeam": "one digit", "MatchDate": "2015-8-8"},
        {"HomeTeam": "empty", "MatchDate": ""},
        {"HomeTeam": "odd season", "Season": "first/16"},
    )
    frame = clean_and_enrich(source)
    found = {r["home_team"]: r for r in frame.collect()}
    assert found["ok"]["match_date"] == date(2015, 8, 8)
    assert [found[n]["match_date"] for n in ("slashes", "no such day", "one digit", "empty")] == [None] * 4
    assert found["ok"]["season_start_year"] == 2015
    assert found["odd season"]["season_start_year"] is None
    assert sorted(r["home_team"] for r in drop_incomplete(frame).collect()) == ["odd season", "ok"]
    assert tuple(count_staged(source).first()) == (6, 6, 2)
    assert tuple(count_staged(source, "2015").first()) == (6, 5, 1)


def test_team_trim_removes_spaces_only(raw):
    rows = raw({"HomeTeam": "  A  "}, {"HomeTeam": "\tB"}, {"HomeTeam": "   "}, {"HomeTeam": None})
    kept = stage_matches(rows, ["2015/16"])
    assert sorted(r["home_team"] for r in kept.collect()) == ["", "\tB", "A"]
    strict = stage_matches(rows, ["2015/16"], blank_as_null=True)
    assert sorted(r["home_team"] for r in strict.collect()) == ["\tB", "A"]


def test_missing_goals_drop_the_row_and_other_gaps_do_not(raw):
    rows = raw({"FullTimeHomeGoals": None}, {"FullTimeAwayGoals": None}, {"HomeShots": None})
    (row,) = stage_matches(rows, ["2015/16"]).collect()
    assert row["home_shots"] is None
    assert row["total_goals"] == 1


def test_ingested_at_can_be_given(raw):
    stamp = datetime(2024, 5, 1, 12, 30)
    assert clean_and_enrich(raw({}), ingested_at=stamp).first()["ingested_at"] == stamp


def test_summaries(raw):
    staged = stage_matches(
        raw({}, {"Season": "2016/17"}, {"HomeTeam": "Z"}), ["2015/16", "2016/17"]
    )
    assert [tuple(r) for r in rows_per_season(staged).collect()] == [("2015/16", 2), ("2016/17", 1)]
    assert [r["home_team"] for r in sample_rows(staged, 2).collect()] == ["A", "Z"]


def test_stg_matches_reads_dates_stored_as_text(raw):
    staged = stage_matches(raw({}), ["2015/16"], ingested_at=datetime(2024, 5, 1))
    as_text = staged.withColumn("match_date", staged["match_date"].cast("string"))
    assert stg_matches(as_text).collect() == stg_matches(staged).collect()
    assert dict(stg_matches(as_text).dtypes)["match_date"] == "date"


@pytest.mark.parametrize(
    ("half", "full", "comeback"),
    [("A", "H", True), ("H", "A", True), ("H", "H", False), ("D", "A", False), ("A", "D", False),
     (None, "H", False), ("A", None, False)],
)
def test_comeback(raw, half, full, comeback):
    rows = raw({"HalfTimeResult": half, "FullTimeResult": full})
    assert match_facts(stage_matches(rows, ["2015/16"])).first()["comeback_win"] is comeback


def test_second_half_goals_and_high_scoring(raw):
    rows = raw(
        {"FullTimeHomeGoals": 3, "FullTimeAwayGoals": 2, "HalfTimeHomeGoals": 1},
        {"FullTimeHomeGoals": 3, "FullTimeAwayGoals": 1, "HalfTimeHomeGoals": None},
    )
    facts = match_facts(stage_matches(rows, ["2015/16"])).orderBy("total_goals").collect()
    assert [(r["home_sh_goals"], r["away_sh_goals"], r["high_scoring"]) for r in facts] == [
        (None, 1, False), (2, 2, True),
    ]
