"""Connected components of a graph that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.llm.tables import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (src, dst longs); root is the least node.

    Every round hangs each node's larger neighbours on its least one, then each node and
    its smaller neighbours on the least of them, until all hang on their root. Each round
    is written to the shared folder, so its lineage is one file scan.
    """
    state = edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    )
    before = None
    while True:
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        larger = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = written(smaller.union(least).distinct(), "components")
        mark = state.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if mark == before:
            break
        before = mark
    roots = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
