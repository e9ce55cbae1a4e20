"""Raw matches derived from an ``orders`` table, one per order.

The expressions are fixed values that also run unchanged in ANSI SQL engines, so
the same text feeds the reference queries of the correctness check. Twenty teams;
orders from August to July form a season; some rows lack a season, a date, goals,
shots or a half-time result, and a third of the home teams are padded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.seasons import season_labels

# Six full seasons; the orders also hold parts of 1994/95 and 2001/02.
FIXTURE_SEASONS = season_labels(1995, 2000)

# Names used by the columns below, over an order's keys and date.
BASE_EXPRESSIONS = {
    "k": "o_orderkey",
    "c": "o_custkey",
    "d": "cast(o_orderdate as date)",
    "sy": "cast(year(o_orderdate) - case when month(o_orderdate) >= 8 then 0 else 1 end as int)",
    "h": "o_custkey % 20",
    "a": "(o_custkey % 20 + 1 + o_orderkey % 19) % 20",
    "hg": "cast(((o_orderkey * 31 + o_custkey * 17) % 97) % 5 as int)",
    "ag": "cast(((o_orderkey * 13 + o_custkey * 29) % 89) % 4 as int)",
}
HALF_TIME_EXPRESSIONS = {
    "hh": "cast(case when k % 2 = 0 then hg else least(hg, 1) end as int)",
    "ah": "cast(case when k % 4 = 1 then ag else least(ag, 1) end as int)",
}

# The raw columns in header order.
COLUMN_EXPRESSIONS = {
    "Season": "case when k % 499 = 0 then null else concat(cast(sy as string), '/', "
    "lpad(cast((sy + 1) % 100 as string), 2, '0')) end",
    "MatchDate": "case when k % 211 = 0 then null else cast(d as string) end",
    "HomeTeam": "case when k % 3 = 0 then concat('  TEAM_', lpad(cast(h as string), 2, '0'), ' ') "
    "else concat('TEAM_', lpad(cast(h as string), 2, '0')) end",
    "AwayTeam": "concat('TEAM_', lpad(cast(a as string), 2, '0'))",
    "FullTimeHomeGoals": "case when k % 197 = 0 then null else hg end",
    "FullTimeAwayGoals": "ag",
    "FullTimeResult": "case when hg > ag then 'H' when hg < ag then 'A' else 'D' end",
    "HalfTimeHomeGoals": "hh",
    "HalfTimeAwayGoals": "ah",
    "HalfTimeResult": "case when k % 101 = 0 then null when hh > ah then 'H' when hh < ah then 'A' else 'D' end",
    "HomeShots": "case when k % 89 = 0 then null else cast(hg + 3 + k % 11 as int) end",
    "AwayShots": "cast(ag + 2 + c % 11 as int)",
    "HomeShotsOnTarget": "cast(hg + k % 3 as int)",
    "AwayShotsOnTarget": "cast(ag + c % 2 as int)",
    "HomeCorners": "cast(k % 13 as int)",
    "AwayCorners": "cast(c % 11 as int)",
    "HomeFouls": "cast(k % 17 as int)",
    "AwayFouls": "cast(c % 19 as int)",
    "HomeYellowCards": "cast(k % 5 as int)",
    "AwayYellowCards": "cast(c % 4 as int)",
    "HomeRedCards": "case when k % 23 = 0 then 1 else 0 end",
    "AwayRedCards": "case when c % 29 = 0 then 1 else 0 end",
}

# Changes that make raw text dirty, over the columns above.
DIRTY_EXPRESSIONS = {
    "Season": "case when HomeCorners = 4 then Season || chr(9) else Season end",
    "MatchDate": "case HomeCorners when 1 then MatchDate || ' 15:00' when 2 then 'n/a' "
    "when 3 then ' ' || MatchDate else MatchDate end",
    "HomeTeam": "case when HomeCorners = 5 then chr(9) || ' ' when HomeCorners = 9 then chr(160) "
    "when HomeCorners = 10 then chr(160) || HomeTeam else HomeTeam end",
    "AwayTeam": "case when HomeCorners = 6 then '' else AwayTeam end",
    "FullTimeAwayGoals": "case when AwayCorners = 0 then cast(FullTimeAwayGoals as string) || '.0' "
    "else cast(FullTimeAwayGoals as string) end",
    "HomeShots": "case when AwayCorners = 1 then ' ' else cast(HomeShots as string) end",
}

# Results that are missing or unknown, over the columns above.
FAULTY_RESULT = "case HomeCorners when 7 then null when 8 then 'X' else FullTimeResult end"
# Columns that a faulty file lacks.
LACKING = ("HomeFouls", "AwayFouls")


def faulty_results(raw: DataFrame) -> DataFrame:
    """The raw matches with some results null and some unknown."""
    return raw.selectExpr(
        *[f"{FAULTY_RESULT} AS {c}" if c == "FullTimeResult" else c for c in raw.columns]
    )


def dirty_text(raw: DataFrame) -> DataFrame:
    """The raw matches with blanks, tabs, decimals and unreadable dates in some columns."""
    return raw.selectExpr(
        *[f"{DIRTY_EXPRESSIONS[c]} AS {c}" if c in DIRTY_EXPRESSIONS else c for c in raw.columns]
    )


def matches_from_orders(orders: DataFrame) -> DataFrame:
    """Raw matches; of ``orders`` only the two keys and the date are read."""
    base = orders.selectExpr(*[f"{sql} AS {name}" for name, sql in BASE_EXPRESSIONS.items()])
    halves = base.selectExpr("*", *[f"{sql} AS {name}" for name, sql in HALF_TIME_EXPRESSIONS.items()])
    return halves.selectExpr(*[f"{sql} AS {name}" for name, sql in COLUMN_EXPRESSIONS.items()])


def read_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"))
