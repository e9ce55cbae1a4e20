"""Sums over all subtrees of a forest, by parallel tree contraction in join rounds.

A round rakes and compresses. Rake takes every leaf away and adds its sum to its parent's.
Compress takes nodes with one remaining child out of their chain, no two neighbours at
once: a node goes if its coin of the round shows heads and its parent's tails. The child
is hung on the grandparent and remembers, on its link, what the node between would have
added. Leaves and chain nodes are a constant share of any tree, so the rounds grow with
the logarithm of its size, for a single chain as well, and the work with its size.

Re-expansion follows the nodes taken out of chains to those under them, by doubling
pointers, until each hangs on a raked node, whose sum is known.

Each round is written to the shared folder, so its lineage is one file scan. Raked sums
meet on the map side first; every join is unique on one side and its other side holds a
node once, or once for each node of one chain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstats.llm.tables import written


def _heads(node: str, turn: int) -> Column:
    return F.xxhash64(F.lit(turn), F.col(node)) % 2 == 0


def _raked(alive: DataFrame, sums: list[str]) -> DataFrame:
    """All nodes, with ``leaf``: nothing hangs on them any more."""
    parents = alive.where("parent IS NOT NULL").select(F.col("parent").alias("_of")).distinct()
    return alive.join(parents, F.col("id") == F.col("_of"), "left").select(
        "id", "parent", *sums, *[f"link_{s}" for s in sums], F.col("_of").isNull().alias("leaf")
    )


def _without_leaves(flagged: DataFrame, sums: list[str]) -> DataFrame:
    """The other nodes, with their leaves' sums added, and ``unary``: one child remains."""
    below = flagged.where("parent IS NOT NULL").groupBy(F.col("parent").alias("_of")).agg(
        F.count_if(~F.col("leaf")).alias("_left"),
        *[F.sum(F.when(F.col("leaf"), F.col(s) + F.col(f"link_{s}"))).alias(f"_add_{s}") for s in sums],
    )
    return flagged.where(~F.col("leaf")).join(below, F.col("id") == F.col("_of")).select(
        "id", "parent",
        *[(F.col(s) + F.coalesce(f"_add_{s}", F.lit(0))).alias(s) for s in sums],
        *[f"link_{s}" for s in sums],
        (F.col("_left") == 1).alias("unary"),
    )


def _compressed(rest: DataFrame, sums: list[str], turn: int) -> DataFrame:
    """Without the chosen chain nodes; ``spliced`` is the one taken out above a node, if any,
    and ``under_*`` what that node's sum has beside the sum of this one."""
    chosen = F.col("unary") & F.col("parent").isNotNull() & _heads("id", turn) & ~_heads("parent", turn)
    marked = rest.withColumn("_out", F.coalesce(chosen, F.lit(False)))
    out = marked.where("_out").select(
        F.col("id").alias("spliced"), F.col("parent").alias("_above"),
        *[F.col(s).alias(f"_sum_{s}") for s in sums],
        *[F.col(f"link_{s}").alias(f"_link_{s}") for s in sums],
    )
    kept = marked.where("NOT _out").join(out, F.col("parent") == F.col("spliced"), "left")
    was_spliced = F.col("spliced").isNotNull()
    return kept.select(
        "id",
        F.when(was_spliced, F.col("_above")).otherwise(F.col("parent")).alias("parent"),
        *sums,
        *[
            (F.col(f"link_{s}") + F.coalesce(F.col(f"_sum_{s}") + F.col(f"_link_{s}"), F.lit(0))).alias(f"link_{s}")
            for s in sums
        ],
        "spliced",
        *[(F.col(f"_sum_{s}") + F.col(f"link_{s}")).alias(f"under_{s}") for s in sums],
    )


def _resolved(links: DataFrame, sums: list[str]) -> DataFrame:
    """(id, child, sums): each link followed until its child is in no other link's place."""
    links = written(links, "links")
    while True:
        after = links.select(
            F.col("id").alias("_id"), F.col("child").alias("_child"),
            *[F.col(s).alias(f"_{s}") for s in sums],
        )
        links = written(
            links.join(after, F.col("child") == F.col("_id"), "left").select(
                "id",
                F.coalesce("_child", "child").alias("child"),
                *[(F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in sums],
                F.col("_id").isNotNull().alias("moved"),
            ),
            "links",
        )
        if links.where("moved").isEmpty():
            return links.drop("moved")


def subtree_sums(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """(id, sums) for each node: every sum taken over the node and all nodes below it.

    ``nodes`` has ``id`` (unique), ``parent`` (an id, null for a root) and the long columns
    ``sums``. Parents must be nodes and there must be no cycle.
    """
    alive = nodes.select("id", "parent", *sums, *[F.lit(0).cast("long").alias(f"link_{s}") for s in sums])
    known, links, turn = [], [], 0
    while True:
        flagged = written(_raked(alive, sums), "raked")
        known.append(flagged.where("leaf").select("id", *sums))
        if flagged.where("NOT leaf").isEmpty():
            break
        alive = written(_compressed(_without_leaves(flagged, sums), sums, turn), "compressed")
        links.append(
            alive.where("spliced IS NOT NULL").select(
                F.col("spliced").alias("id"), F.col("id").alias("child"),
                *[F.col(f"under_{s}").alias(s) for s in sums],
            )
        )
        turn += 1
    raked = reduce(DataFrame.union, known)
    if not links:
        return raked
    followed = _resolved(reduce(DataFrame.union, links), sums)
    ends = raked.select(F.col("id").alias("_end"), *[F.col(s).alias(f"_{s}") for s in sums])
    expanded = followed.join(ends, F.col("child") == F.col("_end")).select(
        "id", *[(F.col(s) + F.col(f"_{s}")).alias(s) for s in sums]
    )
    return raked.union(expanded)
