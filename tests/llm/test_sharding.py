from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from matchstats.llm.sharding import _scattered, shard_digest, shuffle_into_shards, write_shards
from tests.llm.conftest import rows_of

ROWS = [(i, f"text {i}" * (i % 7), i % 3) for i in range(1000)] + [
    (None, None, 0), (None, "x", 1), (5, None, 2), (7, "same", 0), (7, "same", 0), (8, "y" * 300_000, 1),
]
SCHEMA = "doc_id long, text string, shard int"


def test_every_row_is_kept_in_shards_of_equal_counts(spark, documents):
    sharded = shuffle_into_shards(documents(ROWS, SCHEMA), 40, bucket_bytes=20_000)
    assert sharded.columns == ["doc_id", "text", "shard", "shard_", "slot"]
    found = sharded.collect()
    assert Counter(tuple(r)[:3] for r in found) == Counter(ROWS)
    slots: dict[int, list[int]] = {}
    for row in found:
        slots.setdefault(row.shard_, []).append(row.slot)
    assert set(slots) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_order_follows_rows_and_seed_only(spark, documents):
    def places(frame, seed=0):
        return rows_of(shuffle_into_shards(frame, 7, seed=seed, bucket_bytes=20_000))

    frame = documents(ROWS, SCHEMA)
    assert places(frame) == places(frame.repartition(5).orderBy("shard"))
    assert places(frame) != places(frame, seed=1)


def test_neighbours_are_scattered(spark, documents):
    frame = documents([(i, "t") for i in range(2000)])
    order = [r.doc_id for r in shuffle_into_shards(frame, 4).orderBy("shard", "slot").collect()]
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 20


def test_repeated_rows_fill_no_bucket(spark, documents):
    rows = [(1, "same " * 100)] * 3000 + [(None, None)] * 900 + [(i, f"text {i}") for i in range(600)]
    frame = documents(rows).withColumn("_order", F.lit("x")).repartition(4)
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    placed = _scattered(frame, size, 0, 90, 20_000, ["doc_id", "text", "_order_", "_bucket"])
    assert placed.columns == ["doc_id", "text", "_order", "_order_", "_bucket"]
    counts = [r["count"] for r in placed.groupBy("_bucket").count().collect()]
    assert len(counts) == 90 and max(counts) < 3 * 4500 / 90
    sharded = shuffle_into_shards(frame, 40, bucket_bytes=20_000)
    found = sharded.collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    places = Counter(r.shard for r in found)
    assert len(places) == 40 and max(places.values()) - min(places.values()) <= 1
    assert len({(r.shard, r.slot) for r in found}) == len(rows)


def test_fewer_rows_than_shards_and_none(spark, documents):
    few = shuffle_into_shards(documents([(1, "a"), (2, "b")]), 40).collect()
    assert sorted(r.slot for r in few) == [0, 0] and len({r.shard for r in few}) == 2
    assert shuffle_into_shards(documents([]), 40).count() == 0


def test_digest(spark, documents):
    row = shard_digest(shuffle_into_shards(documents([(1, "é")]), 40)).first()
    assert (row["size"], row.text_crc32) == (18, zlib.crc32("é".encode()))
    assert (row.law, row.slot, row.grown_shard) == ("rows", 0, None)
    null = shard_digest(shuffle_into_shards(documents([(1, None)]), 40)).first()
    assert (null["size"], null.text_crc32) == (16, 0)


def test_written_shards(spark, documents, tmp_path):
    sharded = shuffle_into_shards(documents(ROWS[:50], SCHEMA).drop("shard"), 4)
    write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(back.select("doc_id", "shard", "slot")) == rows_of(
        sharded.select("doc_id", "shard", "slot")
    )
