from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest

from matchstats.llm import mixing
from matchstats.llm.mixing import mix, mixture, mixture_digest
from tests.llm.conftest import rows_of

SCHEMA = "doc_id long, text string, source string"


def corpus(count=3000, hot=0.4):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(count):
        source = "a" if draw.random() < hot else [None, "b", "c", "é", "z"][draw.integers(5)]
        rows.append((i, "w " * int(draw.integers(0, 60)), source))
    return rows


def brute_targets(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {
            s: most * sizes[s] if s in full else rest * weight[s] / open_weight for s in names
        }
        above = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not above:
            return sizes, target
        full |= above


def test_targets_and_words_taken(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rows = corpus()
    units = mixing.round_copies  # several levels: blocks of 100 documents
    monkeypatch.setattr(mixing, "round_copies", lambda u, seed: units(u, seed, 100))
    found = mixture_digest(mixture(documents(rows, SCHEMA))).collect()
    sizes, targets = brute_targets(rows)
    assert sorted(r.doc_id for r in found) == list(range(len(rows)))
    taken = defaultdict(int)
    for row in found:
        assert row["size"] == len(rows[row.doc_id][1].split())
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(targets[row.source])
        assert row.taken in (0, row["size"], 2 * row["size"])
        taken[row.source] += row.taken
    for source, target in targets.items():
        assert taken[source] == pytest.approx(target, rel=0.03)


def test_reruns_agree_whatever_the_partitions(spark, documents):
    frame = documents(corpus(400), SCHEMA)
    assert rows_of(mixture(frame)) == rows_of(mixture(frame.repartition(11)))
    assert rows_of(mixture(frame)) != rows_of(mixture(frame, seed=1))


def test_each_document_is_due_its_chance():
    """Over many seeds a unit is taken as often as it is due."""
    import pandas as pd

    units = pd.DataFrame(
        {"unit": np.arange(1, 9), "weight": [9, 7, 7, 5, 4, 3, 2, 1],
         "due": [0.2, 1.5, 0.9, 0.5, 0.4, 1.0, 0.25, 0.25]}
    )
    total = np.zeros(8)
    for seed in range(3000):
        done = mixing._pivotal(seed, 0)(units.copy()).sort_values("unit")
        assert abs(done["due"].sum() - 5.0) < 1e-6
        total += done["due"].to_numpy()
    assert np.allclose(total / 3000, units["due"], atol=0.05)


def test_mixture_rows_keep_their_columns(spark, documents):
    rows = [(i, "a b c", "s", i * 2) for i in range(30)] + [(None, None, None, 7)] * 2
    frame = documents(rows, SCHEMA + ", unit int")
    mixed = mix(frame)
    assert mixed.columns == frame.columns
    counts = Counter(tuple(r) for r in mixed.collect())
    taken = {r.doc_id: r.copies for r in mixture(frame).collect()}
    assert all(counts[r] == taken[r[0]] * (2 if r[0] is None else 1) for r in rows)


def test_nothing_to_mix(spark, documents):
    assert mixture(documents([], SCHEMA)).count() == 0
    assert mix(documents([], SCHEMA)).count() == 0
    empty = mixture_digest(mixture(documents([(1, None, None), (2, "", "s")], SCHEMA))).collect()
    assert [(r["size"], r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2
