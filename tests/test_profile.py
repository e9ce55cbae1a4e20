from __future__ import annotations

from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.functions.text import WHITESPACE, is_blank, strip_whitespace
from matchstats.operators.profile import (
    covered_matches,
    profile_blanks,
    profile_frequency,
    profile_malformed,
    profile_rollup,
    profile_totals,
    season_coverage,
    settled,
    summarise,
)


def totals(raw):
    return profile_totals(summarise(raw), raw).first()


@pytest.fixture
def text(raw):
    """Raw matches as text, as the profile scan reads them."""

    def build(*changes):
        base = raw({})
        base = base.select(*[F.col(c).cast("string").alias(c) for c in base.columns])
        parts = [base.withColumns({k: F.lit(v).cast("string") for k, v in c.items()}) if c else base for c in changes]
        return reduce(DataFrame.unionByName, parts)

    return build


def pairs(frame):
    return {r[0]: r[1] for r in frame.collect()}


SAMPLES = ["", " ", "\t\n", " ", "  ", "\x1c", "a", " a ", "\ta ", "é", "　é\x85", "a b", "~", "\x7f"]


def test_whitespace_agrees_with_python(spark):
    frame = spark.createDataFrame([(s,) for s in SAMPLES] + [(None,)], "s string")
    rows = frame.select("s", is_blank(F.col("s")), strip_whitespace(F.col("s"))).collect()
    for value, blank, stripped in rows:
        assert blank == (not (value or "").strip())
        assert stripped == (None if value is None else value.strip())
    assert len(WHITESPACE) == 29


def test_blanks_and_malformed_differ(text):
    summary = summarise(
        text(
            {},
            {"HomeShots": ""},
            {"HomeShots": "\t "},
            {"HomeShots": None},
            {"HomeShots": "2.0"},
            {"HomeShots": "many", "MatchDate": "8 Aug"},
            {"HomeShots": " 5 ", "MatchDate": " 2015-08-08"},
        )
    )
    blanks, malformed = pairs(profile_blanks(summary)), pairs(profile_malformed(summary))
    assert blanks["HomeShots"] == 3
    assert sum(blanks.values()) == 3
    assert malformed["HomeShots"] == 3
    assert malformed["MatchDate"] == 2
    assert sum(malformed.values()) == 5


def test_frequencies_trim_and_count_blanks_as_a_key(text):
    summary = summarise(
        text({}, {"Season": " 2015/16\t"}, {"Season": None}, {"Season": " "}, {"FullTimeResult": ""})
    )
    assert pairs(profile_frequency(summary, "season")) == {"": 2, "2015/16": 3}
    assert pairs(profile_frequency(summary, "result")) == {"": 1, "H": 4}


def test_rollup_is_all_three_reports(text):
    summary = summarise(text({}, {"Season": " 2016/17"}, {"Season": None}, {"FullTimeResult": "X"}))
    rows = {(r.report, r.key): r.matches for r in profile_rollup(summary).collect()}
    assert rows == {
        ("season", "2015/16"): 2, ("season", "2016/17"): 1, ("season", ""): 1,
        ("result", "H"): 3, ("result", "X"): 1, ("total", None): 4,
    }
    plan = profile_rollup(summary)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1
    assert profile_rollup(summarise(text({}).where("false"))).collect() == []


def test_totals_compare_dates_as_text(text):
    rows = ({}, {"MatchDate": "2016-01-02"}, {"MatchDate": "2014-12-31 "}, {"MatchDate": " "})
    total = totals(text(*rows))
    assert tuple(total) == (4, 1, "2014-12-31", "2016-01-02")
    odd = ({"MatchDate": "08/08/2015"}, {"MatchDate": "unknown"}, {"Season": None})
    total = totals(text(*rows, *odd))
    assert tuple(total) == (7, 2, "08/08/2015", "unknown")


@pytest.mark.parametrize(
    "dates",
    [
        ["2015-08-08 15:00:01", "2015-08-08 15:00:00", "2015-08-08 15:00:10", "2015-08-08"],
        ["unknown", "unknown day", "unknown day of the month", "unknown day of a month"],
        ["é", "e", "日本語日本語", "日本語日本", "z\u00e9"], ["a\0b", "a", "a\0", "a\0\0c"],
        ["01234567890123", "012345678901234", "0123456789012"], [None, " "], ["x", None],
    ],
)
def test_extremes_of_any_text_are_exact(text, tmp_path, dates):
    rows = text(*[{"MatchDate": d} for d in dates])
    present = sorted((d for d in dates if d and d.strip()), key=str.encode)
    expected = (present[0], present[-1]) if present else (None, None)
    assert tuple(totals(rows))[2:] == expected
    summary = settled(summarise(rows), rows, str(tmp_path / "summary"))
    assert tuple(profile_totals(summary).first()) == (len(dates), 1, *expected)
    assert pairs(profile_frequency(summary, "season")) == {"2015/16": len(dates)}


def test_unsettled_dates_are_refused(text):
    with pytest.raises(ValueError, match="settle"):
        profile_totals(summarise(text({})))


def test_totals_of_no_rows(text):
    empty = text({}).where("false")
    assert tuple(totals(empty)) == (0, 0, None, None)
    assert set(pairs(profile_blanks(summarise(empty))).values()) == {0}


def test_coverage(text):
    summary = summarise(
        text({}, {}, {"Season": "2016/17"}, {"Season": "2016"}, {"Season": None})
    )
    listed = "2015/16, 2016, 2014/15"
    assert [tuple(r) for r in season_coverage(summary, listed).collect()] == [
        ("2014/15", False, 0), ("2015/16", True, 2), ("2016", True, 2),
    ]
    assert covered_matches(summary, listed).first()[0] == 4
    assert season_coverage(summary, []).collect() == []
    assert covered_matches(summary, []).first()[0] == 0


def test_coverage_total_counts_a_match_once(text):
    summary = summarise(text({}))
    assert covered_matches(summary, ["2015/16", "2015"]).first()[0] == 1
