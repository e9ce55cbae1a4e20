"""Sharding by a two-pass external shuffle.

Pass one scatters the rows uniformly over buckets by a seeded hash of id and text, as
many buckets as keep each near ``bucket_bytes`` of text. Pass two puts each bucket's rows
in a canonical order, shuffles them (Fisher-Yates, seeded by the bucket) and numbers
them. The buckets, one after the other, are a random order of all rows; it is cut into
shards whose row counts are at most one apart.

Each row is kept once, repeated rows and rows with null id or text included; a text's
bytes are its size, a null text has none. Identical rows are interchangeable. Rows equal in
id and text that together outgrow a bucket are spread over all buckets, by where they are
read and how many like them were read there before. But for those, the order depends on
rows, seed, bucket and shard counts only, not on files or partitions. Columns
are kept under their names; added ones get an underscore where a name is taken. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats.llm.tables import free_name, with_fields
from matchstats.llm.textbytes import mixed

BUCKET_BYTES = 16 << 20


def _shuffled(
    seed: int, bucket: str, order: str, columns: list[str], added: list[str], shards: int
) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def shuffle(rows: pa.Table, offset: pa.Table) -> pa.Table:
        number = rows.column(bucket)[0].as_py()
        before, total = (offset.column(n)[0].as_py() for n in ("_before", "_all"))
        canonical = pc.sort_indices(rows, sort_keys=[(order, "ascending")]).to_numpy()
        places = np.random.Generator(np.random.Philox([seed, number])).permutation(len(canonical))
        # Shard s holds the places from the first at or after s * all / shards on.
        place = before + np.arange(len(canonical))
        shard = place * shards // total
        slot = place - -(-shard * total // shards)
        shuffled = rows.select(columns).take(pa.array(canonical[places]))
        for name, values in zip(added, (pa.array(shard, pa.int32()), pa.array(slot, pa.int64()))):
            shuffled = shuffled.append_column(name, values)
        return shuffled

    return shuffle


def _spread(order: str, buckets: int):
    """Buckets of rows that share ``order``, by task and by how often it was met in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = np.uint64(TaskContext.get().partitionId() << 32)
        met: dict[int, int] = {}
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(order)).to_numpy()
            found, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
            before = np.array([met.get(key, 0) for key in found.tolist()], np.int64)
            met.update(zip(found.tolist(), (before + counts).tolist()))
            times = np.empty(len(keys), np.int64)
            times[np.argsort(which, kind="stable")] = np.arange(len(keys)) - np.repeat(
                np.cumsum(counts) - counts, counts
            )
            times += before[which]
            number = mixed(mixed(task + times.view(np.uint64)) ^ keys.view(np.uint64)) % np.uint64(buckets)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(number.astype(np.int64))], batch.schema.names
            )

    return run


def _scattered(
    frame: DataFrame, size: Column, seed: int, buckets: int, bucket_bytes: int, columns: list[str]
) -> DataFrame:
    """The rows with the hash of id and text (order) and the number of their bucket."""
    doc_id, text, order, bucket = columns
    hashed = frame.withColumn(order, F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)))
    scattered = hashed.withColumn(
        bucket, F.pmod(F.xxhash64(F.lit(seed + 1), F.col(order)), F.lit(buckets))
    )
    same = hashed.groupBy(order).agg(F.count("*").alias("_n"), F.sum(size + F.lit(64)).alias("_bytes"))
    # Over a bucket each, so there are fewer than buckets: 8 bytes for each 16 MB of text.
    large = same.where((F.col("_n") > 1) & (F.col("_bytes") > bucket_bytes)).select(order)
    large = frame.sparkSession.createDataFrame(large.collect(), large.schema)
    if large.isEmpty():
        return scattered
    few, many = (scattered.join(F.broadcast(large), order, kind) for kind in ("left_anti", "left_semi"))
    names = [*frame.columns, order, bucket]
    spread = many.select(names).mapInArrow(_spread(order, buckets), many.select(names).schema)
    return few.select(names).unionByName(spread)


def shuffle_into_shards(
    frame: DataFrame,
    shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 0,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The rows with (shard int, slot long), in random order over all shards.

    A bucket's rows come out together, in slot order, so writing the frame writes whole
    runs of a shard.
    """
    shard, slot = free_name(frame, "shard"), free_name(frame, "slot")
    bucket, order = (free_name(frame, n) for n in ("_bucket", "_order"))
    size = F.coalesce(F.octet_length(text), F.lit(0))
    total = frame.agg(F.sum(size + F.lit(64)).alias("bytes")).first()["bytes"] or 0
    buckets = max(1, -(-total // bucket_bytes))

    scattered = _scattered(frame, size, seed, buckets, bucket_bytes, [doc_id, text, order, bucket])
    # One row for each bucket: where its rows begin in the order of all rows.
    counts = scattered.groupBy(bucket).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(bucket).alias("_of"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias("_all"),
    )
    # Each bucket meets its offset where it is shuffled, so that rows move once.
    return (
        scattered.groupBy(bucket)
        .cogroup(offsets.groupBy("_of"))
        .applyInArrow(
            _shuffled(seed, bucket, order, frame.columns, [shard, slot], shards),
            with_fields(frame, **{shard: T.IntegerType(), slot: T.LongType()}),
        )
    )


def write_shards(sharded: DataFrame, path: str, shard: str = "shard") -> None:
    """Writes each shard's rows into a folder of its own, without another shuffle.

    A folder's files hold whole buckets in slot order, in the order of their names.
    """
    sharded.write.partitionBy(shard).parquet(path)


def shard_digest(sharded: DataFrame) -> DataFrame:
    """Sizes, checksums and places of all rows; the law is equal row counts."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return sharded.select(
        "doc_id",
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
