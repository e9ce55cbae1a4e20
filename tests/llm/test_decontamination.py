from __future__ import annotations

import numpy as np
import pytest

from matchstats.llm.decontamination import (
    _candidates,
    find_passages,
    index_items,
    weighted_similarity,
    without_passages,
)
from tests.llm.conftest import rows_of

ITEMS = "item_id long, text string"


@pytest.fixture
def items(words):
    sizes = [15, 17, 20, 26, 31, 40, 48, 59]
    return [(i, words(n, 50 + i)) for i, n in enumerate(sizes)] + [(98, None), (99, " ..")]


def test_copied_passages_are_found_at_any_place(spark, documents, words, items):
    rows = []
    for place in range(14):
        for i, text in items[:8]:
            rows.append((i * 100 + place, f"{words(place, place)} {text} {words(30, i)}"))
    rows += [(5000, None), (5001, ""), (5002, words(4000, 7)), (None, items[0][1])]
    found = find_passages(documents(rows), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(d, d // 100) for d, _ in rows if d is not None and d < 5000} | {(None, 0)}
    assert all(r.similarity == 1.0 for r in found)
    places = {r.doc_id: (r.first_word, r.n_words) for r in found}
    assert places[705] == (5, 59)


def test_edits_within_the_similarity(spark, documents, words, items):
    long = items[7][1].split()
    changed = " ".join([*long[:30], "changed", *long[31:]])
    loud = items[7][1].upper().replace(" ", "\n-- ")
    missing = " ".join(long[1:])
    half = " ".join(long[:30]) + " " + words(29, 3)
    rows = [(1, f"{words(9, 1)} {changed} {words(9, 2)}"), (2, loud), (3, missing), (4, half)]
    found = {r.doc_id: r.similarity for r in find_passages(documents(rows), spark.createDataFrame(items, ITEMS)).collect()}
    assert found.keys() == {1, 2, 3} and found[2] == 1.0
    assert found[1] == pytest.approx(50 / 60) and found[3] == pytest.approx(54 / 55)


def test_items_in_blocks(spark, documents, items):
    rows = [(i, text) for i, text in items]
    whole = find_passages(documents(rows), spark.createDataFrame(items, ITEMS))
    blocks = find_passages(documents(rows), spark.createDataFrame(items, ITEMS), at_once=3)
    assert rows_of(whole) == rows_of(blocks) and whole.count() == 8


def test_clean_documents_stay_with_their_columns(spark, documents, words, items):
    rows = [(1, f"x {items[3][1]}", "a"), (2, words(200, 9), "b"), (None, None, "c"), (2, words(200, 9), "b")]
    frame = documents(rows, "doc_id long, text string, item string")
    for at_once in (2000, 4):
        kept = without_passages(frame, spark.createDataFrame(items, ITEMS), at_once=at_once)
        assert kept.columns == frame.columns
        assert sorted(r.item for r in kept.collect()) == ["b", "b", "c"]


def test_empty_tables(spark, documents, items):
    none = spark.createDataFrame([], ITEMS)
    assert find_passages(documents([(1, "a b c")]), none).count() == 0
    assert without_passages(documents([(1, "a b c")]), none).count() == 1
    assert find_passages(documents([]), spark.createDataFrame(items, ITEMS)).count() == 0


def test_blocks_hold_every_fingerprint_within_the_radius(words):
    index = index_items([(i, words(40, i)) for i in range(20)])
    made, draw = index.classes[0], np.random.default_rng(0)
    near = []
    for value in made.prints[draw.integers(len(made.prints), size=500)].tolist():
        for bit in draw.permutation(64)[: int(draw.integers(0, 12))]:
            value ^= 1 << int(bit)
        near.append(value)
    prints = np.array(near, np.uint64)
    found = set(zip(*(x.tolist() for x in _candidates(made, prints, 7))))
    distances = np.bitwise_count(prints[:, None] ^ made.prints)
    assert found == set(zip(*(x.tolist() for x in np.nonzero(distances <= 7))))


def test_weighted_similarity():
    assert weighted_similarity({1: 2, 2: 1}, {1: 1, 3: 1})[0] == 1 / 4
    assert weighted_similarity({}, {})[0] == 0.0
