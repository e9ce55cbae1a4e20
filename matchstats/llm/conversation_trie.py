"""A prefix trie of conversations: which openings are shared, and what sharing them saves.

A node is a distinct sequence of first turns (role, text); a conversation is a member of
the node of each of its openings, from the textless root on. Members are counted by
grouping all openings at once: an opening's key combines 128 hashed bits of each of its
turns with their places, a running exclusive-or, so that equal openings of different
conversations meet without ever being put together as text. Subtree totals come from
parallel tree contraction.

Turns are ordered by turn (null first), then role and text; a null role or text is empty.
Rows without a conversation id belong to no conversation and are left out. Repeated rows
are turns of their own. Conversations that have no turns count where ``members`` names
them. Of no conversations at all the trie is empty; otherwise it has a root. Columns other
than the four are not read.

A turn is one row throughout: a long conversation passes as a sorted stream that spills,
never as one value. Openings, members and children that very many rows share are counted
on the map side first, and their ids are digested from pieces sorted beforehand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchstats.llm.joins import looked_up
from matchstats.llm.tables import written
from matchstats.llm.tree_contraction import subtree_sums

#: Ids in one piece of a node's list.
PIECE_IDS = 4096
_NODE = "struct<a:bigint,b:bigint>"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text), places from 1 on."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return turns.select("conv_id", F.row_number().over(order).alias("place"), "role", "text")


def _openings(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, id, parent, chars, last) for every opening that has turns."""
    of = Window.partitionBy("conv_id").orderBy("depth")
    turns = numbered_turns(conversations).withColumnRenamed("place", "depth")
    hashed = turns.withColumns(
        {name: F.xxhash64(F.lit(lane), "depth", "role", "text") for lane, name in ((1, "a"), (2, "b"))}
    )
    so_far = of.rowsBetween(Window.unboundedPreceding, 0)
    summed = hashed.withColumns(
        {
            "all_a": F.bit_xor("a").over(so_far),
            "all_b": F.bit_xor("b").over(so_far),
            "last": F.lead("depth").over(of).isNull(),
        }
    )
    return summed.select(
        "conv_id", "depth", "last",
        F.struct(F.col("all_a").alias("a"), F.col("all_b").alias("b")).alias("id"),
        F.struct(
            F.col("all_a").bitwiseXOR(F.col("a")).alias("a"),
            F.col("all_b").bitwiseXOR(F.col("b")).alias("b"),
        ).alias("parent"),
        F.char_length("text").cast("long").alias("chars"),
    )


def _root() -> Column:
    zero = F.lit(0).cast("long")
    return F.struct(zero.alias("a"), zero.alias("b"))


def _runs(keys: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """First and behind-last rows of equal neighbouring (a, b)."""
    if not keys.num_rows:
        return
    a, b = (keys.column(n).to_numpy() for n in ("a", "b"))
    edges = [0, *((a[1:] != a[:-1]) | (b[1:] != b[:-1])).nonzero()[0] + 1, len(a)]
    yield from zip(edges[:-1], edges[1:])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run of a node's sorted ids as texts of at most PIECE_IDS ids."""
    for batch in batches:
        rows = []
        ids = batch.column("conv_id").to_pylist()
        for start, stop in _runs(batch):
            a, b = batch.column("a")[start].as_py(), batch.column("b")[start].as_py()
            for at in range(start, stop, PIECE_IDS):
                part = ids[at : min(stop, at + PIECE_IDS)]
                rows.append((a, b, part[0], ",".join(map(str, part))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int64()] * 3 + [pa.string()])],
            ["a", "b", "first", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node from its sorted pieces, which may go over several batches."""
    key, digest, done = None, None, []
    for batch in batches:
        texts = batch.column("ids").to_pylist()
        for start, stop in _runs(batch):
            at = (batch.column("a")[start].as_py(), batch.column("b")[start].as_py())
            if at != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = at, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(",".join(texts[start:stop]).encode())
        if done:
            yield _digest_rows(done)
            done = []
    if key is not None:
        yield _digest_rows([(*key, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["a", "b", "ends_sha256"]
    )


def ends_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) from (id, conv_id): SHA-256 of a node's ids, ascending, comma-joined.

    A digest needs its ids one after the other. Sorting and joining them, which is nearly
    all the work, is spread by range; what meets in one task for a node is a row for each
    PIECE_IDS ids, read as a stream.
    """
    flat = ends.select("id.a", "id.b", "conv_id")
    spread = flat.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    pieces = spread.mapInArrow(_pieces, "a bigint, b bigint, first bigint, ids string")
    met = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    digests = met.mapInArrow(_digests, "a bigint, b bigint, ends_sha256 string")
    return digests.select(F.struct("a", "b").alias("id"), "ends_sha256")


def prefix_trie(conversations: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``conv_id`` is the least member and ``parent_conv_id`` the parent's (null for the
    root). ``n_leaves`` counts the childless nodes of the subtree and ``saved_tokens`` sums
    over it (members - 1) times the code points of a node's last text, tops included.
    ``members`` (conv_id) are all conversations, if some have no turns.
    """
    openings = written(_openings(conversations), "openings")
    ids = openings.where("depth = 1").select("conv_id")
    if members is not None:
        ids = members.where("conv_id IS NOT NULL").select("conv_id").distinct()
    ids = written(ids, "members")
    everyone = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    root = everyone.where("n_convs > 0").select(
        _root().alias("id"), F.lit(None).cast(_NODE).alias("parent"), F.lit(0).alias("depth"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"),
    )
    grouped = openings.groupBy("id", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars")
    )
    found = written(grouped.select(root.columns).union(root), "nodes")
    children = (
        found.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = written(
        found.join(children, "id", "left").select(
            "id", "parent", "depth", "conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        "nodes",
    )
    totals = subtree_sums(nodes, ["n_leaves", "saved_tokens"])
    # Turnless conversations end at the root.
    turnless = ids.join(openings.where("depth = 1").select("conv_id"), "conv_id", "left_anti")
    ends = openings.where("last").select("id", "conv_id").union(turnless.select(_root().alias("id"), "conv_id"))
    whole = (
        nodes.drop("n_leaves", "saved_tokens").join(totals, "id")
        .join(ends_digests(ends), "id", "left")
        .fillna(hashlib.sha256().hexdigest(), ["ends_sha256"])
    )
    tops = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return looked_up(written(whole, "whole-nodes"), tops, ["parent"]).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
        "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )


def with_shared_heads(conversations: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Conversations rebuilt so that many share their opening: (conv_id, turn, role, text).

    Conversation c gets the first h turns of the conversation its block of ids begins with
    (c - c % block) in place of its own first h; h is the checksum of its id modulo ``most``.
    """
    turns = written(numbered_turns(conversations), "turns")
    head = F.col("conv_id") - F.col("conv_id") % block
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    own = turns.where(F.col("place") > heads).select(
        "conv_id", (F.col("place") + F.lit(most)).alias("turn"), "role", "text"
    )
    wanted = turns.where("place = 1").select("conv_id", head.alias("_head"), heads.alias("_turns"))
    lent = turns.where((F.col("conv_id") % block == 0) & (F.col("place") < most)).select(
        F.col("conv_id").alias("_head"), F.col("place").alias("turn"), "role", "text"
    )
    shared = wanted.join(lent, "_head").where(F.col("turn") <= F.col("_turns"))
    return own.union(shared.select(own.columns))
