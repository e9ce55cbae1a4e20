"""Raw matches as CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schemas import RAW_COLUMNS


def write_raw(raw: DataFrame, path: str) -> None:
    """Write the 22 raw columns; nulls as empty fields, padding in names kept."""
    raw.select(*RAW_COLUMNS).write.mode("overwrite").options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
