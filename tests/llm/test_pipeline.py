from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from matchstats.llm.decontamination import find_passages
from matchstats.llm.queries import queries
from matchstats.llm.simhash import near_duplicates
from matchstats.llm.tables import read_table, written
from tests.llm.conftest import SF_DIR, rows_of


def test_names():
    assert [n.split("_")[0] for n in queries()] == [f"op{k}" for k in range(1, 14)]


@pytest.fixture(scope="module")
def staged(spark):
    spark.sparkContext.environment["PYTHONPATH"] = str(corpus_pipeline.__file__.rpartition("/")[0])
    docs = read_table(spark, SF_DIR, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), f"test-{name}")
        found.append(docs)
    return found


def test_stages_keep_the_columns_and_only_remove_rows(staged):
    raw, quality, deduped, clean, mixed, sharded = staged
    assert all(f.columns == raw.columns for f in staged[:-1])
    assert sharded.columns == [*raw.columns, "shard", "slot"]
    for before, after in [(raw, quality), (quality, deduped), (deduped, clean)]:
        left = Counter(map(tuple, after.collect()))
        left.subtract(Counter(map(tuple, before.collect())))
        assert max(left.values()) <= 0
    assert set(rows_of(mixed)) <= set(rows_of(clean))
    assert rows_of(mixed) == rows_of(sharded.select(raw.columns))


def test_decisions_take_effect(spark, staged):
    _, quality, deduped, clean, mixed, _ = staged
    groups = defaultdict(set)
    for row in near_duplicates(quality).collect():
        groups[row.component_id].add(row.doc_id)
    assert sorted(groups) == sorted(r.doc_id for r in deduped.collect())
    items = read_table(spark, SF_DIR, "benchmark")
    leaks = {r.doc_id for r in find_passages(deduped, items).collect()}
    assert {r.doc_id for r in deduped.collect()} - leaks == {r.doc_id for r in clean.collect()}
    copies = Counter(r.doc_id for r in mixed.collect())
    assert max(copies.values()) <= 2


def test_empty_documents(spark):
    docs = read_table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
