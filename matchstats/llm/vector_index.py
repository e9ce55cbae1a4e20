"""Near-duplicate vectors of equal label, found by an inverted multi-index.

The halves of all unit vectors are clustered apart from each other; a cell of the index is
a pair of a left and a right centroid, so that few centroids make many cells. A vector
lives in its nearest cell and visits others in the order of how near to it their vectors
may be: the squared distances from its halves to the borders of the two centroids'
regions, added up. This multi-sequence traversal stops at a distance that is fitted for the
wanted recall: on sampled vectors and random partners at just the least cosine, the most
distant pairs that count, it must reach that share. A recall of 1 stops only where no
partner can be, which is proven for every pair, but visits most cells. Every candidate is
then verified by its exact cosine.

Cells are compared in blocks of bounded size, so a cell may hold any share of the vectors:
its residents are cut into blocks, every two blocks meet in one task, and so does every
block with every part of the visitors. A pair that both sides find counts once on each
side, as a vector knows the cells it visits. A block answers with numbers of links and a
spanning forest of them, so its output is as long as its input however many pairs are
linked. Equal vectors are compared once.

A vector takes part if label and vector are not null, all its components are finite
numbers and not all of them zero; vectors of different lengths are not comparable. All
other rows, and rows that link with nothing, are returned without links. A row without an
id takes part; a component's id is its least id, null if it has none. Repeated rows are
equal vectors. An empty table gives no rows. Columns other than the three are not read.

The codebooks are fitted on at most ``TRAIN_ROWS`` vectors and ``TRAIN_BYTES`` bytes,
drawn by a hash; every vector is indexed and queried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstats.llm.components import connected_components
from matchstats.llm.joins import looked_up
from matchstats.llm.simhash import _united
from matchstats.llm.tables import written

LEAST_COSINE, RECALL = 0.93, 0.99
TRAIN_ROWS, TRAIN_BYTES = 20_000, 32 << 20
#: Mean residents of a cell, as long as no half needs more than MOST_CENTROIDS.
CELL_ROWS, MOST_CENTROIDS = 512, 512
#: Residents of a cell that one task compares with another so many.
BLOCK_ROWS = 2048
ROUNDS = 12


@dataclass(frozen=True)
class ProductIndex:
    """Centroids of the left and the right halves, and how far the traversal goes."""

    left: np.ndarray
    right: np.ndarray
    reach: float

    def _borders(self, half: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest centroid, and its squared distance to every centroid's region.

        The region of a centroid lies behind the plane half way to it, so the distance to
        that plane is a lower bound.
        """
        squares = (centroids**2).sum(axis=1)
        distances = (half**2).sum(axis=1)[:, None] - 2 * half @ centroids.T + squares
        home = distances.argmin(axis=1)
        apart = np.sqrt(np.maximum(squares[:, None] + squares - 2 * centroids @ centroids.T, 0))
        gap = distances - distances[np.arange(len(half)), home][:, None]
        between = 2 * apart[home]
        planes = np.divide(gap, between, out=np.zeros_like(gap), where=between > 0)
        planes[np.arange(len(half)), home] = 0
        return home, np.maximum(planes, 0) ** 2

    def halves(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        middle = self.left.shape[1]
        return units[:, :middle], units[:, middle:]

    def homes(self, units: np.ndarray) -> np.ndarray:
        a, b = self.halves(units)
        return self._borders(a, self.left)[0] * len(self.right) + self._borders(b, self.right)[0]

    def distances(self, units: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """The traversal's distance from each vector to the cell beside it."""
        a, b = self.halves(units)
        rows = np.arange(len(units))
        return (
            self._borders(a, self.left)[1][rows, cells // len(self.right)]
            + self._borders(b, self.right)[1][rows, cells % len(self.right)]
        )

    def visits(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home cells, all visited cells vector by vector, and the offsets of each one's.

        Both halves' centroids are sorted by distance. For one rank on the left after the
        other, all vectors at once, the ranks on the right that stay within reach are a
        first part of the list; once it is empty a vector is done.
        """
        a, b = self.halves(units)
        home_a, near_a = self._borders(a, self.left)
        home_b, near_b = self._borders(b, self.right)
        order_a, order_b = near_a.argsort(axis=1, kind="stable"), near_b.argsort(axis=1, kind="stable")
        near_a, near_b = np.take_along_axis(near_a, order_a, 1), np.take_along_axis(near_b, order_b, 1)
        rows, cells = [], []
        alive = np.arange(len(units))
        for rank in range(len(self.left)):
            alive = alive[near_a[alive, rank] <= self.reach]
            if not len(alive):
                break
            within = near_b[alive] <= (self.reach - near_a[alive, rank])[:, None]
            row, second = np.nonzero(within)
            rows.append(alive[row])
            cells.append(order_a[alive[row], rank] * len(self.right) + order_b[alive[row], second])
        whole_rows = np.concatenate([np.zeros(0, np.int64), *rows])
        whole_cells = np.concatenate([np.zeros(0, np.int64), *cells])
        by_row = np.lexsort((whole_cells, whole_rows))
        counts = np.bincount(whole_rows, minlength=len(units))
        return home_a * len(self.right) + home_b, whole_cells[by_row], np.concatenate([[0], np.cumsum(counts)])


def _clustered(points: np.ndarray, count: int, draw: np.random.Generator) -> np.ndarray:
    if not points.shape[1]:
        return np.zeros((1, 0))
    centroids = points[draw.choice(len(points), count, replace=False)].copy()
    for _ in range(ROUNDS):
        squares = (centroids**2).sum(axis=1)
        nearest = (squares - 2 * points @ centroids.T).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=count)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return np.unique(centroids, axis=0)


def fit_index(sample: np.ndarray, count: int, cosine: float, recall: float, seed: int = 0) -> ProductIndex:
    """Codebooks of at most ``count`` centroids a half over unit vectors, and their reach."""
    draw = np.random.default_rng(seed)
    middle = sample.shape[1] // 2
    count = min(count, len(sample))
    index = ProductIndex(
        _clustered(sample[:, :middle], count, draw), _clustered(sample[:, middle:], count, draw), 0.0
    )
    farthest = 2 - 2 * cosine
    if recall >= 1:
        return ProductIndex(index.left, index.right, farthest * (1 + 1e-9))
    # Partners in random directions at exactly the least cosine.
    units = sample[: 1 << 12]
    aside = draw.standard_normal(units.shape)
    aside -= (aside * units).sum(axis=1)[:, None] * units
    lengths = np.linalg.norm(aside, axis=1)
    units, aside = units[lengths > 0], aside[lengths > 0] / lengths[lengths > 0][:, None]
    partners = cosine * units + np.sqrt(1 - cosine**2) * aside
    needed = np.minimum(
        index.distances(units, index.homes(partners)), index.distances(partners, index.homes(units))
    )
    reach = float(np.quantile(needed, recall)) if len(needed) else farthest
    return ProductIndex(index.left, index.right, min(reach, farthest) * (1 + 1e-9))


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All components one after the other, offsets, and which vectors take part."""
    column = column.cast(pa.large_list(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(column)
    values = flat.to_numpy(zero_copy_only=False).astype(float)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    some = np.concatenate([[0], np.cumsum(values != 0)])
    fine = (np.diff(bad[offsets]) == 0) & (np.diff(some[offsets]) > 0)
    return values, offsets, fine


def _unit(values: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled before, so that squares neither overflow nor vanish."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _comparable(vectors: DataFrame) -> DataFrame:
    """Rows that take part, their vector as bytes of doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values, offsets, fine = _values(batch.column("vector"))
            rows = np.flatnonzero(fine)
            raw = [values[offsets[k] : offsets[k + 1]].tobytes() for k in rows.tolist()]
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [kept.column("row"), kept.column("vec_id"), kept.column("label"), pa.array(raw, pa.binary())],
                ["row", "vec_id", "label", "raw"],
            )

    usable = vectors.where(F.col("label").isNotNull() & F.col("vector").isNotNull())
    label = usable.schema["label"].dataType.simpleString()
    identity = usable.schema["vec_id"].dataType.simpleString()
    return usable.mapInArrow(run, f"row long, vec_id {identity}, label {label}, raw binary")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Equally long binary values as unit rows."""
    joined = b"".join(column.to_pylist())
    return _unit(np.frombuffer(joined).reshape(len(column), -1))


def _placed(broadcasts: dict):
    """Adds home cell and visited cells to each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for width in np.unique(dims):
                index = broadcasts[int(width)].value
                rows = np.flatnonzero(dims == width)
                for at in range(0, len(rows), 4096):
                    part = batch.take(pa.array(rows[at : at + 4096]))
                    home, cells, offsets = index.visits(_matrix(part.column("raw")))
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(cells, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(home, pa.int64()), lists], [*part.schema.names, "home", "cells"]
                    )

    return run


def _compared(cosine: float):
    """Links of a block of residents with another one or itself, and with visitors."""

    def compare(table: pa.Table) -> pa.Table:
        first, second = table.column("block")[0].as_py(), table.column("part")[0].as_py()
        side = table.column("side").to_numpy()
        nodes, weights = table.column("node").to_numpy(), table.column("copies").to_numpy()
        units = _matrix(table.column("raw"))
        links = np.zeros(len(nodes), np.int64)
        parent = np.arange(len(nodes))
        rows = np.flatnonzero(side == 0)
        if first == second:
            close = units[rows] @ units[rows].T >= cosine
            np.fill_diagonal(close, False)
            links[rows] += close @ weights[rows]
            parent = _united(parent, *(rows[k] for k in np.nonzero(np.triu(close, 1))))
        others = np.flatnonzero(side == 1)
        if len(others):
            close = units[rows] @ units[others].T >= cosine
            links[rows] += close @ weights[others]
            links[others] += weights[rows] @ close
            i, j = np.nonzero(close)
            parent = _united(parent, rows[i], others[j])
        guests = np.flatnonzero(side == 2)
        if len(guests):
            of = table.column("cells").combine_chunks()
            homes = table.column("home").to_numpy()
            lists = of.take(pa.array(rows))
            visited = pc.list_flatten(lists).to_numpy()
            owner = np.repeat(np.arange(len(rows)), pc.list_value_length(lists).to_numpy())
            for home in np.unique(homes[guests]):
                # Residents that visit the guests' home find the same pairs there.
                returns = np.zeros(len(rows), bool)
                returns[owner[visited == home]] = True
                here = guests[homes[guests] == home]
                for at in range(0, len(here), BLOCK_ROWS):
                    some = here[at : at + BLOCK_ROWS]
                    close = units[rows] @ units[some].T >= cosine
                    links[some] += weights[rows] @ close
                    links[rows[~returns]] += close[~returns] @ weights[some]
                    i, j = np.nonzero(close)
                    parent = _united(parent, rows[i], some[j])
        found = np.flatnonzero((links > 0) | (parent != np.arange(len(nodes))))
        return pa.table({"node": nodes[found], "links": links[found], "to": nodes[parent[found]]})

    return compare


def _indexes(classes: DataFrame, cosine: float, recall: float, cell_rows: int) -> dict:
    """A fitted, broadcast index for each length of vectors."""
    spark = classes.sparkSession
    sizes = classes.groupBy("dims", "label").count().groupBy("dims").agg(F.max("count").alias("most"))
    indexes = {}
    for row in sizes.collect():
        width = row["dims"]
        rows = max(2, min(TRAIN_ROWS, TRAIN_BYTES // (8 * width)))
        order = F.xxhash64("raw")
        drawn = classes.where(F.col("dims") == width).orderBy(order, "node").limit(rows).select("raw")
        sample = _unit(np.frombuffer(b"".join(bytes(r["raw"]) for r in drawn.collect())).reshape(-1, width))
        count = int(np.clip(np.ceil(np.sqrt(row["most"] / cell_rows)), 1, MOST_CENTROIDS))
        indexes[width] = spark.sparkContext.broadcast(fit_index(sample, count, cosine, recall))
    return indexes


def linked_vectors(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = LEAST_COSINE,
    recall: float = RECALL,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the least id
    reachable by links, and ``kept`` says that it is the row's own.
    """
    rows = written(
        embeddings.select(
            F.monotonically_increasing_id().alias("row"), F.col(vec_id).alias("vec_id"),
            F.col(label).alias("label"), F.col(vector).alias("vector"),
        ),
        "vectors",
    )
    comparable = written(_comparable(rows).withColumn("dims", (F.octet_length("raw") / 8).cast("int")), "comparable")
    # Equal vectors are one class, named by one of its rows.
    same = [F.xxhash64("label", "raw").alias("h1"), F.sha2("raw", 256).alias("h2")]
    keyed = comparable.select("row", "vec_id", "label", "dims", "raw", *same)
    classes = keyed.groupBy("label", "dims", "h1", "h2").agg(
        F.min("row").alias("node"), F.min("vec_id").alias("least"), F.count("*").alias("copies")
    )
    classes = written(classes, "classes")
    named = classes.select(F.col("node").alias("row"), "node", "copies")
    vectors = written(
        keyed.join(named, "row").select("node", "label", "dims", "copies", "raw"), "class-vectors"
    )
    indexes = _indexes(vectors, cosine, recall, cell_rows)
    home_of = vectors.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    placed = written(
        vectors.mapInArrow(_placed(indexes), f"{home_of}, home long, cells array<long>"), "placed"
    )
    where = ["label", "dims", "cell"]
    resident = F.col("cell") == F.col("home")
    spread = placed.select("node", "home", "label", "dims", F.explode("cells").alias("cell"))
    visits = written(spread, "visits")
    # Parts of a cell: its blocks of residents, and behind them those of its visitors.
    sizes = visits.groupBy(*where).agg(
        F.ceil(F.count_if(resident) / block_rows).cast("int").alias("blocks"),
        F.ceil(F.count_if(~resident) / (4 * block_rows)).cast("int").alias("guests"),
    )
    # A cell without residents has nothing to be compared with.
    sizes = written(sizes.where("blocks > 0"), "cell-blocks")
    met = looked_up(visits.drop("home"), sizes, where).where("blocks IS NOT NULL")
    met = met.join(placed.drop("label", "dims"), "node")
    dealt_by = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    own, guest = dealt_by("blocks"), F.col("blocks") + dealt_by("guests")
    blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    parts = F.sequence(F.lit(0), F.col("blocks") + F.col("guests") - 1)

    def deal(block: Column, part: Column, side: int) -> Column:
        return F.struct(block.alias("block"), part.alias("part"), F.lit(side).alias("side"))

    # As a row of its own block against its own and later parts, as a column of earlier blocks.
    as_rows = F.transform(F.filter(parts, lambda k: k >= own), lambda k: deal(own, k, 0))
    as_columns = F.transform(F.filter(blocks, lambda k: k < own), lambda k: deal(k, own, 1))
    as_guest = F.transform(blocks, lambda k: deal(k, guest, 2))
    deals = F.when(resident, F.concat(as_rows, as_columns)).otherwise(as_guest)
    dealt = met.select("node", "copies", "raw", "home", "cells", *where, F.explode(deals).alias("deal")).select(
        "node", "copies", "raw", "home", "cells", *where, "deal.*"
    )
    answers = written(
        dealt.groupBy(*where, "block", "part").applyInArrow(_compared(cosine), "node long, links long, to long"),
        "vector-links",
    )
    counts = answers.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(answers.select(F.col("node").alias("src"), F.col("to").alias("dst")))
    whole = (
        classes.join(counts, "node", "left").join(roots, "node", "left")
        .select(
            "label", "dims", "h1", "h2", "least", F.coalesce("root", "node").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    whole = written(whole, "linked-classes")
    least = whole.groupBy("root").agg(F.min("least").alias("component"))
    of_class = written(whole.join(least, "root"), "component-classes")
    of_rows = looked_up(
        written(keyed.select("row", "label", "dims", "h1", "h2"), "row-classes"),
        of_class.select("label", "dims", "h1", "h2", "n_links", "component"),
        ["label", "dims", "h1", "h2"],
    ).select("row", "n_links", "component")
    found = rows.select("row", "vec_id").join(of_rows, "row", "left")
    linked = F.coalesce("n_links", F.lit(0)).cast("long")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return found.select(
        "vec_id", linked.alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
