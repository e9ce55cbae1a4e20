"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is due the same number of copies, its source's target over
its source's size. The whole part is certain; the fraction is a probability. Documents
of one source are paired: at random, one of the two hands mass to the other until a
probability is 0 or 1, and the other goes on to the next pair. Pairs are neighbours in
size, so the words taken stay near the target. Blocks of documents are rounded side by
side, each leaving at most one undecided document; those are the input of the next
level, down to one for each source, which is drawn.

Sizes are word counts; a null text has none. Rows with equal id, source and text are one
unit: all of them are taken equally often. A null source is a source of its own; null ids
are told apart by text. Draws depend on ids, texts and the seed only, so reruns agree.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchstats.llm.tables import free_name, written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_UNITS = 2_000
FAN_IN = 1_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Adds ``target`` to (source, source_size): one row for each source.

    Sources take the weights in turn, by code point, null last. Together they get
    ``share`` of all sizes, but each at most ``most`` of its own; what is above that goes
    to the others by weight. Both follow from one level: target = min(level * weight,
    cap), where sources are full in the order of cap over weight.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    by_weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.row_number().over(place) - 1) % len(weights) + 1
    )
    capped = sources.withColumn("weight", by_weight.cast("double")).withColumn(
        "cap", F.col("source_size") * F.lit(most)
    )
    fills = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source"))
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    leveled = capped.withColumns(
        {
            "level": (F.sum("source_size").over(everything) * share - filled) / weight_left,
            "place": F.row_number().over(fills),
        }
    )
    # The level at the first source that it does not fill; those before it are full.
    open_level = F.min(
        F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    ).over(everything)["level"]
    return leveled.select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("cap"), open_level * F.col("weight")), F.col("cap")).alias(
            "target"
        ),
    )


def _pivotal(seed: int, level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rounds one block; its last row may stay undecided (its ``due`` not a whole number)."""

    def round_block(units: pd.DataFrame) -> pd.DataFrame:
        units = units.sort_values(["weight", "unit"], ascending=False, kind="stable")
        base = np.floor(units["due"].to_numpy() + 1e-12)
        chances = np.clip(units["due"].to_numpy() - base, 0, 1).tolist()
        mark = int(np.bitwise_xor.reduce(units["unit"].to_numpy())) & (2**64 - 1)
        draws = np.random.Generator(np.random.Philox([seed, level, mark])).random(len(units))
        held = -1
        for i, draw in enumerate(draws.tolist()):
            chance = chances[i]
            if chance < 1e-9 or chance > 1 - 1e-9:
                chances[i] = round(chance)
                continue
            if held < 0:
                held = i
                continue
            other = chances[held]
            both = other + chance
            if both <= 1:
                winner, loser = (held, i) if draw * both < other else (i, held)
                chances[winner], chances[loser] = both, 0
            else:
                # One is taken; the other keeps what is left over.
                winner, loser = (held, i) if draw * (2 - both) < 1 - chance else (i, held)
                chances[winner], chances[loser] = 1, both - 1
                winner = loser
            held = winner if 1e-9 < chances[winner] < 1 - 1e-9 else -1
            if held < 0:
                chances[winner] = round(chances[winner])
        units["due"] = base + chances
        units["open"] = False
        if held >= 0:
            units.iloc[held, units.columns.get_loc("open")] = True
        return units

    return round_block


def round_copies(units: DataFrame, seed: int = 0, block_units: int = BLOCK_UNITS) -> DataFrame:
    """Adds ``copies`` to (unit, source, weight, due, ...), one row for each unit.

    ``unit`` is a hash that tells units apart, ``due`` the expected copies.
    """
    schema = units.withColumns({"_block": F.lit(0).cast("long"), "open": F.lit(True)}).schema
    sizes = units.groupBy("source").agg(F.count("*").alias("_units"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_units") / block_units))
    of = sizes.withColumnRenamed("source", "_of")
    dealt = units.join(of, F.col("source").eqNullSafe(F.col("_of"))).select(
        *units.columns, F.pmod(F.xxhash64(F.lit(seed), "unit"), blocks).cast("long").alias("_block")
    )
    level, decided = 0, None
    while True:
        rounded = written(
            dealt.groupBy("source", "_block").applyInPandas(
                _pivotal(seed, level), schema
            ),
            f"mix-level-{level}",
        )
        done = rounded.where(~F.col("open"))
        decided = done if decided is None else decided.unionByName(done)
        still = rounded.where("open")
        many = still.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        if many <= 1:
            break
        level += 1
        dealt = still.select(
            *units.columns, F.floor(F.col("_block") / FAN_IN).cast("long").alias("_block")
        )
    # The last undecided unit of a source is drawn by its own hash.
    chance = F.col("due") - F.floor("due")
    draw = F.pmod(F.xxhash64(F.lit(seed + 1), "unit"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    last = still.withColumn(
        "due", F.floor("due") + F.when(draw < chance, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    return decided.unionByName(last).select(
        *(c for c in units.columns if c != "due"), F.round("due").cast("long").alias("copies")
    )


def mixture(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 0,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """(unit, doc_id, source, size, rows, source_size, target, copies): how often to take each
    document; equal rows are one line."""
    sized = written(
        documents.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            words(F.col(text)).alias("size"),
            F.xxhash64(F.col(doc_id), F.col(source), F.col(text)).alias("unit"),
        ),
        "mix-sizes",
    )
    targets = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most
    ).withColumnRenamed("source", "_source")
    units = sized.groupBy("unit", "doc_id", "source", "size").agg(F.count("*").alias("rows"))
    due = units.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
        *units.columns,
        "source_size",
        "target",
        (F.col("size") * F.col("rows")).alias("weight"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(F.lit(0.0))
        .alias("due"),
    )
    return round_copies(due, seed).drop("weight")


def mix(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    **settings,
) -> DataFrame:
    """The documents of the mixture, each as often as it is taken, with their own columns."""
    of, unit_of, copies, copy = (
        free_name(documents, name) for name in ("_id", "_unit", "_copies", "_copy")
    )
    taken = mixture(documents, doc_id, text, source, **settings).where("copies > 0")
    taken = taken.select(
        F.col("unit").alias(unit_of), F.col("doc_id").alias(of), F.col("copies").alias(copies)
    )
    unit = F.xxhash64(*(documents[name] for name in (doc_id, source, text)))
    # By a shuffle of the rows at every size; the other side grows with them.
    rows = documents.join(
        taken.hint("merge"), (unit == F.col(unit_of)) & documents[doc_id].eqNullSafe(F.col(of))
    ).select(
        *(documents[name] for name in documents.columns),
        F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(copy),
    )
    return rows.drop(copy)


def mixture_digest(units: DataFrame) -> DataFrame:
    """One row for each document, with the words the mixture takes of it."""
    return units.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "copies",
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_row"),
    ).drop("_row")
