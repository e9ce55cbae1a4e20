"""One reading of a season list, used by the filter, the scan and the coverage report.

A list may mix full labels (``2015/16``) and start years (``2015``), given as a
Python list or as one comma-separated string.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def season_labels(first: int, last: int) -> list[str]:
    """Labels of the seasons starting in the years ``first`` to ``last``."""
    return [f"{year}/{(year + 1) % 100:02d}" for year in range(first, last + 1)]


# Fixed value: the seasons of a run that names none.
DEFAULT_SEASONS = season_labels(2015, 2024)


def parse_seasons(seasons: str | Iterable[str]) -> list[str]:
    """Trimmed, de-duplicated entries in the order given; blank ones are ignored."""
    entries = seasons.split(",") if isinstance(seasons, str) else seasons
    return list(dict.fromkeys(e.strip() for e in entries if e and e.strip()))


def start_year_text(season: Column) -> Column:
    """Text before the slash, or all of it without one."""
    return F.substring_index(season, "/", 1)


def start_year(season: Column) -> Column:
    """Integer before the slash, null where it is not a number."""
    return start_year_text(season).try_cast("int")


def season_condition(seasons: str | Iterable[str] | None, season: Column) -> Column:
    """True where the season, or the part before its slash, is one of the entries.

    No list at all keeps every row with a season, an empty one keeps nothing.
    """
    if seasons is None:
        return season.isNotNull()
    entries = parse_seasons(seasons)
    return season.isin(entries) | start_year_text(season).isin(entries)


def partition_condition(seasons: str | Iterable[str], year: Column) -> Column:
    """Test on the partition column that no row passing ``season_condition`` fails.

    A row matches an entry only if both have the same text before the slash, and that
    text decides the row's directory: the year it can be read as, or the one of rows
    without a year. So each entry points at one directory, and the scan opens no other.
    """
    firsts = {entry.partition("/")[0] for entry in parse_seasons(seasons)}
    tests = [year.eqNullSafe(F.lit(first).try_cast("int")) for first in sorted(firsts)]
    return reduce(or_, tests, F.lit(False))
