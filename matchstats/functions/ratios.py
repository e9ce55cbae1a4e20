"""Rounded ratios of aggregates.

Each multiplies first and divides once, so that a percentage such as 29/200 is
14.5 exactly and rounds half up; a zero denominator gives null rather than the
error ANSI mode would raise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.round(numerator / F.nullif(denominator, F.lit(0)), digits)


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def mean(col: Column, digits: int) -> Column:
    return F.round(F.avg(col), digits)
