from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchstats.llm.vector_index import fit_index, linked_vectors

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine=0.93):
    """Links and components of (vec_id, vector, label) with plain all-pairs products."""
    count = len(rows)
    near = np.zeros((count, count), bool)
    for i, (_, a, of_a) in enumerate(rows):
        for j, (_, b, of_b) in enumerate(rows):
            if i != j and of_a is not None and of_a == of_b and fine(a) and fine(b) and len(a) == len(b):
                near[i, j] = np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= cosine
    least = [row[0] for row in rows]
    for _ in range(count):
        least = [min([least[i], *(least[j] for j in np.flatnonzero(near[i]))]) for i in range(count)]
    return near.sum(axis=1), least


def fine(vector):
    return vector is not None and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], lab) for i, v, lab in rows], SCHEMA
    )


@pytest.fixture(scope="module")
def clustered():
    """Groups whose members lie at cosines around the limit, beside lone vectors."""
    draw = np.random.default_rng(3)
    rows = []
    for group in range(60):
        centre = draw.standard_normal(16)
        for _ in range(int(draw.integers(1, 8))):
            rows.append((len(rows) + 1000, centre + draw.standard_normal(16) * draw.choice([0.05, 0.2, 0.27]), group % 3))
    return rows


def result(frame, **settings):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in linked_vectors(frame, **settings).collect()}


def test_exact_recall_equals_brute_force(spark, clustered):
    links, least = brute(clustered)
    found = result(frame(spark, clustered), recall=1.0, cell_rows=4, block_rows=3)
    assert found == {r[0]: (n, c, c == r[0]) for r, n, c in zip(clustered, links.tolist(), least)}
    assert max(links) > 2


def test_default_recall_against_brute_force(spark, clustered):
    links, _ = brute(clustered)
    found = result(frame(spark, clustered), cell_rows=4)
    assert all(found[r[0]][0] <= n for r, n in zip(clustered, links))
    assert sum(f[0] for f in found.values()) >= 0.9 * links.sum()


def test_reach_is_measured_on_pairs_at_the_limit():
    """Partners at just the least cosine, the most distant that count, in many cells."""
    draw = np.random.default_rng(1)
    units = draw.standard_normal((4000, 64))
    units /= np.linalg.norm(units, axis=1)[:, None]
    index = fit_index(units[:2000], 24, 0.93, 0.95)
    aside = draw.standard_normal(units.shape)
    aside -= (aside * units).sum(axis=1)[:, None] * units
    partners = 0.93 * units + np.sqrt(1 - 0.93**2) * aside / np.linalg.norm(aside, axis=1)[:, None]
    forth = index.distances(units, index.homes(partners)) <= index.reach
    back = index.distances(partners, index.homes(units)) <= index.reach
    assert (forth | back).mean() >= 0.9
    _, cells, offsets = index.visits(units)
    assert len(cells) < 0.3 * len(units) * len(index.left) * len(index.right)
    # The visited cells are all those within reach, the home among them.
    every = np.arange(len(index.left) * len(index.right))
    within = index.distances(np.repeat(units[:1], len(every), axis=0), every) <= index.reach
    assert cells[offsets[0] : offsets[1]].tolist() == every[within].tolist()
    assert index.homes(units[:1])[0] in cells[offsets[0] : offsets[1]]


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1, 0], 1), (2, [2, 0], 1), (3, [1, 0], 1), (3, [1, 0], 1), (4, [1, 0], None), (5, [0, 0], 1),
        (6, None, 1), (7, [1, None], 1), (8, [nan, 1], 1), (9, [inf, 1], 1), (10, [], 1), (11, [1, 0, 0], 1),
        (12, [1e-200, 0], 1), (13, [1e200, 1e200], 2), (14, [3, 3], 2), (15, [5], 1), (16, [7], 1), (17, [1, 0], 2),
        (None, [0, 1], 5), (None, [0, 1], 5),
    ]
    clashing = frame(spark, rows).withColumns({"row": F.col("label"), "node": F.lit("x"), "n_links": F.lit(1)})
    found = sorted((tuple(r) for r in linked_vectors(clashing).collect()), key=str)
    alone = [4, 5, 6, 7, 8, 9, 10, 11, 17]
    assert found == sorted(
        [(i, 0, i, True) for i in alone]
        + [(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (3, 4, 1, False), (12, 4, 1, False)]
        + [(13, 1, 13, True), (14, 1, 13, False), (15, 1, 15, True), (16, 1, 15, False)]
        + [(None, 1, None, True), (None, 1, None, True)],
        key=str,
    )


def test_a_hot_cell_and_a_hot_copy(spark):
    """Half of all rows near one vector, a quarter of them the same, over many blocks."""
    draw = np.random.default_rng(7)
    centre = draw.standard_normal(8)
    rows = [(i, centre if i % 2 else centre + 0.01 * draw.standard_normal(8), 0) for i in range(300)]
    rows += [(1000 + i, draw.standard_normal(8), 0) for i in range(300)]
    links, least = brute(rows)
    found = result(frame(spark, rows), cell_rows=16, block_rows=16, recall=1.0)
    assert found == {r[0]: (n, c, c == r[0]) for r, n, c in zip(rows, links.tolist(), least)}


def test_empty(spark):
    assert linked_vectors(frame(spark, [])).collect() == []
    assert result(frame(spark, [(1, None, 1)])) == {1: (0, 1, True)}
