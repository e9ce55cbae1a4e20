"""How rows are placed before they are written.

Seasons are few and may be very uneven. Hashing rows by season would put a dominant
season into one task, so writes ask for a rebalance by season and month instead:
adaptive execution cuts a large month into several tasks and joins small ones. A small
input gives one file per season, a large one evenly sized files of a few months each,
so that a date filter opens few of them. For that the session needs at least as many
shuffle partitions as there are months.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

# Shuffled bytes per write task. Staged rows take about a tenth of that as Parquet, so
# this gives files of some 128 MB.
WRITE_TASK_BYTES = "1280m"


@dataclass(frozen=True)
class Clustering:
    """Rows of a table in so many files by the hash of a column, each file in order.

    A filter on the column reads one file and skips row groups by their statistics;
    groups, windows and joins on it need no exchange. For tables whose rows for any one
    value fit a task, as one season's or one team's do.
    """

    by: str
    order: tuple[str, ...]
    buckets: int = 8

    def place(self, frame: DataFrame) -> DataFrame:
        """One task a bucket, so that a bucket is one file."""
        return frame.repartition(self.buckets, self.by)

    @property
    def clause(self) -> str:
        order = ", ".join(self.order)
        return f"CLUSTERED BY ({self.by}) SORTED BY ({order}) INTO {self.buckets} BUCKETS"


def place_by_month(frame: DataFrame) -> DataFrame:
    """Rows of a season and month next to each other."""
    months = F.year("match_date") * 12 + F.month("match_date")
    placed = frame.withColumn("_month", months)
    return placed.hint("rebalance", F.col("season_start_year"), F.col("_month")).drop("_month")


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The settings for the statements inside, then the former values again."""
    former = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in former.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def write_settings(spark: SparkSession) -> dict[str, str]:
    """Larger tasks for a write, unless the session already names a size.

    It holds for all queries of the session meanwhile; naming a size keeps it as it is.
    """
    named = spark.conf.get(ADVISORY_SIZE, None) is not None
    return {} if named else {ADVISORY_SIZE: WRITE_TASK_BYTES}


def sort_matches(frame: DataFrame) -> DataFrame:
    """Sorted by season and date inside each task, with no shuffle.

    A date filter then skips row groups and pages by their statistics.
    """
    return frame.sortWithinPartitions("season_start_year", "season", "match_date")
