"""Near-duplicate documents by SimHash, found by tiled exact comparison.

A document's fingerprint has a bit set where over half of its shingle hashes have it;
shingles are repeated word sequences of lower-cased text. Distinct fingerprints are put
into tiles by their number of set bits. Tiles whose counts differ by more than the radius
cannot hold a pair and never meet; the others are compared whole, by exclusive-or and bit
counts, after the same test on blocks of rows by the counts of four parts. Each pair of
tiles answers with a spanning forest of its links, so that its output stays as long as
its input however many links there are, and connected components join the answers.

Equal fingerprints are one node, so copies cost nothing. A text without words (null,
empty, blank) has fingerprint zero, linked like any other. Rows with a null id take part;
a component's id is its least id, null if it has none. Repeated rows are copies. An empty
table gives no rows.

The comparison is exact and so quadratic in distinct fingerprints, by its nature; the
tests on counts leave about a third of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats.llm.components import connected_components
from matchstats.llm.tables import free_name, with_fields, written
from matchstats.llm.textbytes import Words, bit_majority, chunks

SHINGLE_WORDS, SEED, RADIUS = 4, 42, 4
TILE = 1 << 15
BLOCK = 64


def fingerprints(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    words = Words(data, offsets)
    starts, ends, groups = words.shingles(size)
    raw, digest = words.buffer.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(raw[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())),
        np.uint64,
        len(starts),
    )
    return bit_majority(hashes, groups)


def fingerprinted(
    documents: DataFrame, text: str = "text", size: int = SHINGLE_WORDS
) -> DataFrame:
    """Adds ``fp``, the 64 bits as a long; the text itself is dropped."""
    kept = [name for name in documents.columns if name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text):
            prints = fingerprints(data, offsets, size).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(rows.schema.get_field_index(n)) for n in kept), pa.array(prints)],
                [*kept, "fp"],
            )

    return documents.mapInArrow(run, with_fields(documents.select(kept), fp=T.LongType()))


def _tile_ranges(counts: dict[int, int], tile: int) -> list[tuple[int, int, int]]:
    """(least bits, most bits, number of tiles): neighbouring counts share a tile if they fit."""
    ranges: list[tuple[int, int, int]] = []
    held = 0
    for bits in sorted(counts):
        if ranges and ranges[-1][2] == 1 and held + counts[bits] <= tile:
            ranges[-1] = (ranges[-1][0], bits, 1)
            held += counts[bits]
        else:
            ranges.append((bits, bits, -(-counts[bits] // tile)))
            held = counts[bits]
    return ranges


def _parts(prints: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(prints).view("<u2").reshape(-1, 4)).astype(np.int16)


def _blocks(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order that puts like part counts together; each block's least and most counts."""
    parts = _parts(prints)
    order = np.lexsort(parts.T)
    parts = parts[order]
    starts = np.arange(0, len(prints), BLOCK)
    return (
        order,
        starts,
        np.minimum.reduceat(parts, starts, axis=0),
        np.maximum.reduceat(parts, starts, axis=0),
    )


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        above = parent[parent]
        if np.array_equal(above, parent):
            return parent
        parent = above


def _united(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The forest after links a-b; every node points at its root, the least of its tree."""
    while True:
        left, right = parent[a], parent[b]
        apart = left != right
        if not apart.any():
            return parent
        low, high = np.minimum(left, right)[apart], np.maximum(left, right)[apart]
        parent = parent.copy()
        np.minimum.at(parent, high, low)
        parent = _roots(parent)
        a, b = a[apart], b[apart]


def linked(left: np.ndarray, right: np.ndarray | None, radius: int) -> np.ndarray:
    """Spanning forest of the links within ``left``, or between it and ``right``.

    Nodes are numbered through both arrays; the result has each one's root.
    """
    both = left if right is None else np.concatenate([left, right])
    if not len(both):
        return np.zeros(0, np.int64)
    right, shift = (left, 0) if right is None else (right, len(left))
    parent = np.arange(len(both))
    if not len(left) or not len(right):
        return parent
    order_a, starts_a, low_a, high_a = _blocks(left)
    order_b, starts_b, low_b, high_b = _blocks(right)
    sorted_a, sorted_b = left[order_a], right[order_b]
    whole = np.arange(BLOCK)
    for k, start in enumerate(starts_a):
        gaps = np.maximum(low_a[k] - high_b, low_b - high_a[k]).clip(0).sum(axis=1)
        near = np.flatnonzero(gaps <= radius)
        if not shift:
            near = near[near >= k]
        rows = sorted_a[start : start + BLOCK]
        for at in range(0, len(near), 64):
            columns = (starts_b[near[at : at + 64]][:, None] + whole).ravel()
            columns = columns[columns < len(sorted_b)]
            close = np.bitwise_count(rows[:, None] ^ sorted_b[columns]) <= radius
            i, j = np.nonzero(close)
            if len(i):
                parent = _united(parent, order_a[start + i], shift + order_b[columns[j]])
    return parent


def _compared(radius: int):
    def compare(pair: pd.DataFrame) -> pd.DataFrame:
        sides = [np.frombuffer(raw, np.uint64) for raw in pair.sort_values("side")["prints"]]
        parent = linked(sides[0], sides[1] if len(sides) > 1 else None, radius)
        nodes = np.concatenate(sides).view(np.int64)
        hung = np.flatnonzero(parent != np.arange(len(parent)))
        return pd.DataFrame({"src": nodes[hung], "dst": nodes[parent[hung]]})

    return compare


def close_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(src, dst): links that connect distinct fingerprints (column fp) within the radius.

    Whatever is linked by a chain of pairs within the radius is linked by these rows.
    """
    bits = F.bit_count("fp").cast("int")
    counts = {r["bits"]: r["count"] for r in prints.groupBy(bits.alias("bits")).count().collect()}
    ranges = _tile_ranges(counts, tile)
    first = np.concatenate([[0], np.cumsum([r[2] for r in ranges])]).astype(int)
    of_bits = {b: k for k, (low, high, _) in enumerate(ranges) for b in range(low, high + 1)}
    # A tile's number: its range's first tile, and a hash within the range.
    base = F.create_map(*(F.lit(int(x)) for b, k in of_bits.items() for x in (b, first[k])))
    split = F.create_map(*(F.lit(int(x)) for b, k in of_bits.items() for x in (b, ranges[k][2])))
    if not ranges:
        return prints.select(F.col("fp").alias("src"), F.col("fp").alias("dst")).limit(0)
    number = base[bits] + F.pmod(F.xxhash64("fp"), split[bits])
    tiles = prints.select("fp", number.cast("long").alias("tile"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        held = np.sort(rows["fp"].to_numpy().view(np.uint64))
        return pd.DataFrame({"tile": rows["tile"].iloc[:1], "prints": [held.tobytes()]})

    packed = tiles.groupBy("tile").applyInPandas(pack, "tile long, prints binary")

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each tile goes to every pair of tiles that it belongs to."""
        for batch in batches:
            for tile_no, raw in zip(batch["tile"], batch["prints"]):
                own = int(np.searchsorted(first, tile_no, "right")) - 1
                for k, (low, high, _) in enumerate(ranges):
                    if max(low - ranges[own][1], ranges[own][0] - high) > radius:
                        continue
                    for other in range(first[k], first[k + 1]):
                        a, b = min(tile_no, other), max(tile_no, other)
                        yield pd.DataFrame(
                            {"a": [a], "b": [b], "side": [int(tile_no != a)], "prints": [raw]}
                        )

    dealt = packed.mapInPandas(deal, "a long, b long, side int, prints binary")
    return dealt.groupBy("a", "b").applyInPandas(_compared(radius), "src long, dst long")


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    size: int = SHINGLE_WORDS,
    tile: int = TILE,
) -> DataFrame:
    """(doc_id, fp, class, component_id): one row for each document.

    ``component_id`` is the least id reachable over links; ``class`` names the component
    also where no member has an id.
    """
    narrow = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = written(fingerprinted(narrow, "text", size), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = written(close_links(distinct.select("fp"), radius, tile), "links")
    roots = connected_components(links)
    classes = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("class")
    )
    least = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    of_print = classes.select("fp", "class").join(least, "class")
    return prints.join(of_print, "fp").select("doc_id", "fp", "class", "component_id")


def one_of_each(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    **settings,
) -> DataFrame:
    """One document of each component of ``near_duplicates`` stays, the one with the least id.

    Rows that share this id and class, or have no id at all, are told apart by a hash of
    the whole row; of rows equal in everything one stays.
    """
    tag, of, id_of = (free_name(documents, name) for name in ("_mark", "_of", "_id"))
    mark = F.xxhash64(*(F.col(f"`{name}`") for name in documents.columns))
    marked = documents.select(
        F.struct(
            F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), mark.alias("mark")
        ).alias("key"),
        F.col(text).alias("text"),
    )
    found = near_duplicates(marked, "key", **settings)
    kept = written(
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy(F.col("doc_id")["id"].alias(id_of), F.col("doc_id")["mark"].alias(of))
        .agg(F.count("*").alias("rows")),
        "kept",
    )
    keyed = documents.withColumn(tag, mark)
    same = keyed[doc_id].eqNullSafe(F.col(id_of)) & (F.col(tag) == F.col(of))
    stays = keyed.join(kept, same, "left_semi").drop(tag)
    # Only where a kept row is repeated must rows be compared whole.
    return stays.distinct() if kept.where("rows > 1").limit(1).count() else stays


def simhash_digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
