"""Joins whose keys may be held by very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.llm.tables import free_name

#: A key is heavy when it is on more than one row in so many; there are at most as many heavy keys.
HEAVY_SHARE = 1000


def looked_up(rows: DataFrame, table: DataFrame, on: list[str], share: int = HEAVY_SHARE) -> DataFrame:
    """Left join of ``rows`` with a ``table`` that is unique in the columns ``on``.

    Rows of heavy keys stay where they are and meet their at most ``share`` lines of the
    table by broadcast; all others are shuffled, at most one row in ``share`` for a key.
    A null key finds nothing. Both frames are read more than once, so give written ones.
    """
    total = rows.count()
    heavy_name = free_name(rows, "_heavy")
    heavy = (
        rows.groupBy(*on).count().where(F.col("count") > max(1, total // share)).select(*on)
    )
    # Proven bound: more than total / share rows each, so at most ``share`` keys.
    # As Arrow data, so that no Python workers are started for them.
    heavy = rows.sparkSession.createDataFrame(heavy.toArrow(), heavy.schema)
    known = F.broadcast(heavy.withColumn(heavy_name, F.lit(True)))
    marked = rows.join(known, on, "left")
    few = table.join(F.broadcast(heavy), on, "left_semi")
    light = marked.where(F.col(heavy_name).isNull()).join(table, on, "left")
    hot = marked.where(F.col(heavy_name)).join(F.broadcast(few), on, "left")
    return light.unionByName(hot).drop(heavy_name)
