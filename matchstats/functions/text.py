"""Blank tests and whitespace trimming on text columns."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; Spark's own trim knows the space only.
WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def _starts_plainly(col: Column) -> Column:
    """True where the first character is visible ASCII: a byte comparison, and the usual case."""
    return (col >= "!") & (col < "\x7f")


def strip_whitespace(col: Column) -> Column:
    """The value without leading or trailing whitespace of any kind."""
    plain = _starts_plainly(col) & _starts_plainly(F.substring(col, -1, 1))
    return F.when(plain, col).otherwise(F.btrim(col, F.lit(WHITESPACE)))


def is_present(col: Column) -> Column:
    """True where text holds more than whitespace; null where it is null."""
    return _starts_plainly(col) | (F.btrim(col, F.lit(WHITESPACE)) != "")


def is_blank(col: Column) -> Column:
    """True where text is null, empty or whitespace only."""
    return ~F.coalesce(is_present(col), F.lit(False))
