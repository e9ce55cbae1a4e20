"""Suffix-array dedup: repeated byte strings across a corpus.

A text is its UTF-8 bytes; matches never cross texts. ``suffix_scan`` says how anchors,
sorted suffixes and the tree of common-prefix intervals find repeats; this module lays
that out over a cluster:

1. Every text gives its anchors: place and hash of a few bytes, no text.
2. Hashes that occur once are dropped, as are those of second and further copies of a
   whole text: copies are counted by their checksum, their bytes are repeated anyway.
3. Texts meet their remaining anchors, and the bytes around each go to the task of its
   hash, where suffixes are sorted and scanned. No more than ``most`` anchors of one hash
   are ever sorted together.
4. Anchors of a hotter hash take another exact way: every string of the least length
   around them is hashed, counted where it is found, and one of each string goes to the
   task of its own hash. Strings, unlike anchors, spread over all tasks.
5. Texts meet the spans found in them.

A row is known by the hash of id and text, so rows equal in both are one text that
occurs more than once. Null texts and texts shorter than the least length hold no
repeats. Null ids are told apart by text. Columns of the input other than id and text
don't matter. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats.llm.suffix_scan import (
    GRAM,
    WINDOW,
    AnchoredSuffixes,
    anchors,
    contexts,
    merged_spans,
    repeated_windows,
    windows,
)
from matchstats.llm.tables import written
from matchstats.llm.textbytes import chunks

LENGTH = 200
#: Most anchors of one hash that are sorted together; and anchors sorted at once.
MOST, AT_ONCE = 8_192, 4_096
#: Strings of hot hashes that one task counts at once, about.
HOT_STRINGS = 200_000

#: Of an anchor: its hash was met once where it was found, or more often.
ALONE, SPEAKS, SURE = 0, 1, 2
_ANCHORS = "row long, place int, key long, kind int"
_HELD = "key long, hot boolean, row long, place int, before int, held binary"
_SPANS = "row long, first int, last int"
_GROUPS = "repeat long, n_bytes int, row long, first int"


def _rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("row"),
    )


def _anchored(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "text"):
            places, hashes = anchors(data, offsets, length)
            text = np.searchsorted(offsets, places, "right") - 1
            numbers = rows.column(rows.schema.get_field_index("row")).to_numpy()
            _, first, which, counts = np.unique(
                hashes, return_index=True, return_inverse=True, return_counts=True
            )
            # Hashes met twice here are repeated for sure; one of each speaks for them.
            kind = np.where(counts[which] > 1, SURE, ALONE)
            kind[first[counts > 1]] = SPEAKS
            columns = [numbers[text], places - offsets[text], hashes.view(np.int64), kind]
            yield _frame(columns, _ANCHORS)

    return run


def _copies(rows: DataFrame) -> DataFrame:
    """(row, stays): rows whose whole text occurs more than once; one of each text stays."""
    summed = written(rows.select("row", F.md5("text").alias("sum")), "checksums")
    many = summed.groupBy("sum").agg(F.count("*").alias("n"), F.min("row").alias("one")).where("n > 1")
    return summed.join(many, "sum").select("row", (F.col("row") == F.col("one")).alias("stays")).distinct()


def _frame(columns: list, names: str) -> pa.RecordBatch:
    fields = [n.split() for n in names.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields]
    )


def _surroundings(length: int, buckets: int):
    """Turns (row, text, marks) into what has to meet: contexts of anchors, and hot strings."""
    before = length - GRAM

    def cold(data, offsets, numbers, text, places) -> pa.RecordBatch:
        at = offsets[text] + places
        held, back, _ = contexts(data, offsets[text], offsets[text + 1], at, before, length)
        ahead = np.minimum(offsets[text + 1] - at, length)
        # The bytes of the text only; the reader puts the padding back.
        raw = [
            held[i, before - b : before + a].tobytes()
            for i, (b, a) in enumerate(zip(back.tolist(), ahead.tolist()))
        ]
        keys = _gram_keys(held[:, before : before + GRAM])
        return _frame([keys, np.zeros(len(at), bool), numbers[text], places, back, raw], _HELD)

    def hot(data, offsets, numbers, text, places) -> Iterator[pa.RecordBatch]:
        found = []
        for one in np.unique(text):
            low, high = int(offsets[one]), int(offsets[one + 1])
            found.append(
                windows(data, low, high, low + places[text == one], before, length, int(numbers[one]))
            )
        again, rest = repeated_windows(np.concatenate(found))
        # Strings met twice here are repeats at once; they need no other task.
        row, first, last = _span_rows(again, length)
        yield _frame(
            [row, np.ones(len(row), bool), row, first, np.full(len(row), -2),
             [int(x).to_bytes(4, "little") for x in last]],
            _HELD,
        )
        bucket = (rest["first"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        parts = np.split(rest[order], cuts) if len(rest) else []
        numbers_of = bucket[order][np.concatenate([[0], cuts])] if len(rest) else []
        count = len(parts)
        yield _frame(
            [numbers_of, np.ones(count, bool), np.zeros(count, np.int64), np.zeros(count, np.int32),
             np.full(count, -1), [p.tobytes() for p in parts]],
            _HELD,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, "text", 1 << 18):
            marks = rows.column(rows.schema.get_field_index("marks"))
            numbers = rows.column(rows.schema.get_field_index("row")).to_numpy()
            counts = np.diff(marks.offsets.to_numpy())
            values = marks.flatten().to_numpy()
            text = np.repeat(np.arange(len(counts)), counts)
            is_hot = values % 2 == 1
            for part in np.array_split(np.flatnonzero(~is_hot), 1 + (~is_hot).sum() // AT_ONCE):
                if len(part):
                    yield cold(data, offsets, numbers, text[part], (values // 2)[part])
            if is_hot.any():
                yield from hot(data, offsets, numbers, text[is_hot], (values // 2)[is_hot])

    return run


def _gram_keys(grams: np.ndarray) -> np.ndarray:
    """A number for each anchor's bytes: equal bytes have equal numbers."""
    lanes = np.ascontiguousarray(grams).view("<u8")
    mark = np.zeros(len(grams), np.uint64)
    for k in range(lanes.shape[1]):
        mark = (mark ^ lanes[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        mark ^= mark >> np.uint64(29)
    return mark.view(np.int64)


def _span_rows(found: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the strings found, those of one text merged."""
    rows, firsts, lasts = [], [], []
    order = np.argsort(found["row"], kind="stable")
    found = found[order]
    cuts = np.flatnonzero(np.diff(found["row"])) + 1
    for part in np.split(found, cuts) if len(found) else []:
        first, last = merged_spans(part["start"].astype(np.int64), part["start"].astype(np.int64) + length)
        rows.append(np.full(len(first), part["row"][0]))
        firsts.append(first)
        lasts.append(last)
    if not rows:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return np.concatenate(rows), np.concatenate(firsts), np.concatenate(lasts)


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches as tables of whole keys, each of about AT_ONCE rows or one key."""
    waiting: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, AT_ONCE)
            at += part.num_rows
            waiting.append(part)
            count += part.num_rows
            if count < AT_ONCE:
                continue
            table = pa.Table.from_batches(waiting)
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            if cut:
                yield table.slice(0, cut)
                waiting, count = table.slice(cut).to_batches(), table.num_rows - cut
    if waiting:
        yield pa.Table.from_batches(waiting)


def _suffixes(table: pa.Table, length: int) -> AnchoredSuffixes:
    before = length - GRAM
    raw = table.column("held").combine_chunks()
    ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2], np.uint8)
    back = table.column("before").to_numpy().astype(np.int64)
    held, _, right = contexts(data, ends[:-1], ends[1:], ends[:-1] + back, before, length)
    return AnchoredSuffixes(table.column("key").to_numpy(), held, back, right, before, length)


def _split(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    hot = table.column("hot").to_numpy()
    return table.filter(pa.array(~hot)), table.filter(pa.array(hot))


def _hot_spans(table: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    kind = table.column("before").to_numpy()
    direct = table.filter(pa.array(kind == -2))
    if direct.num_rows:
        last = [int.from_bytes(b, "little") for b in direct.column("held").to_pylist()]
        yield _frame([direct.column("row").to_numpy(), direct.column("place").to_numpy(), last], _SPANS)
    packed = table.filter(pa.array(kind == -1))
    keys = packed.column("key").to_numpy()
    cuts = np.flatnonzero(np.diff(keys)) + 1
    for part in np.split(np.arange(len(keys)), cuts) if len(keys) else []:
        raw = packed.slice(int(part[0]), len(part)).column("held").to_pylist()
        again, _ = repeated_windows(np.concatenate([np.frombuffer(b, WINDOW) for b in raw]))
        yield _frame(list(_span_rows(again, length)), _SPANS)


def _to_spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches):
            cold, hot = _split(table)
            if hot.num_rows:
                yield from _hot_spans(hot, length)
            if cold.num_rows > 1:
                back, ahead = _suffixes(cold, length).covered()
                found = np.flatnonzero(ahead)
                places = cold.column("place").to_numpy()[found]
                yield _frame(
                    [cold.column("row").to_numpy()[found], places - back[found], places + ahead[found]],
                    _SPANS,
                )

    return run


def _to_groups(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches):
            cold, _ = _split(table)
            if cold.num_rows < 2:
                continue
            rows = cold.column("row").to_numpy()
            places, held = cold.column("place").to_numpy(), cold.column("held")
            backs = cold.column("before").to_numpy()
            for back, ahead, members in _suffixes(cold, length).maximal_repeats():
                at = int(backs[members[0]])
                content = held[int(members[0])].as_py()[at - back : at + ahead]
                mark = int.from_bytes(hashlib.sha256(content).digest()[:8], "little", signed=True)
                count = len(members)
                yield _frame(
                    [np.full(count, mark), np.full(count, back + ahead), rows[members],
                     places[members] - back],
                    _GROUPS,
                )

    return run


def _meeting(rows: DataFrame, copies: DataFrame, length: int, most: int) -> DataFrame:
    """Contexts and hot strings, each key's rows together and in order."""
    found = written(
        rows.select("row", "text").mapInArrow(_anchored(length), _ANCHORS), "anchors"
    )
    # A hot hash has few rows here, one for each chunk of text at most: the others are
    # known. Both sides of the join read one exchange.
    asked = found.where(F.col("kind") < SURE).repartition("key")
    many = asked.groupBy("key").agg(F.sum(F.col("kind") + 1).alias("n")).where("n > 1")
    second = copies.where(~F.col("stays")).select("row")
    repeated = written(
        asked.join(many.select("key"), "key")
        .select("row", "place", "key")
        .unionByName(found.where(F.col("kind") == SURE).select("row", "place", "key"))
        .join(second, "row", "left_anti"),
        "repeated-anchors",
    )
    # Without second copies, some hashes have one anchor left, and few are hot.
    counts = repeated.groupBy("key").agg(F.count("*").alias("n"))
    odd = written(counts.where((F.col("n") == 1) | (F.col("n") > most)), "odd-hashes")
    hot = odd.where(F.col("n") > most).agg(F.sum("n")).first()[0] or 0
    buckets = max(64, -(-hot * (length - GRAM + 1) // HOT_STRINGS))
    # A place and its kind in one number: twice the place, one more if its hash is hot.
    mark = F.col("place").cast("long") * 2 + F.col("n").isNotNull().cast("long")
    marks = (
        repeated.join(odd, "key", "left")
        .where("n IS NULL OR n > 1")
        .groupBy("row")
        .agg(F.collect_set(mark).alias("marks"))
    )
    # With the columns of the last join, so that both read one exchange of the texts.
    held = rows.join(marks, "row").mapInArrow(_surroundings(length, buckets), _HELD)
    return held.repartition("key").sortWithinPartitions("key", "hot")


def maximal_repeats(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
    length: int = LENGTH, most: int = MOST,
) -> DataFrame:
    """(repeat, n_bytes, doc_id, first): maximal repeats with all their occurrences.

    Of texts that occur more than once, one stands for all. Repeats are seen as far as
    ``length`` bytes from an anchor, so a longer one is told in overlapping pieces, one
    for each anchor in it. Hashes with over ``most`` anchors are left out, and their
    repeats with them; ``without_repeats`` covers those too.
    """
    rows = _rows(documents, doc_id, text)
    groups = _meeting(rows, written(_copies(rows), "copies"), length, most).mapInArrow(
        _to_groups(length), _GROUPS
    )
    ids = rows.select("row", "doc_id").distinct()
    return groups.join(ids, "row").select("repeat", "n_bytes", "doc_id", "first").distinct()


def without_repeats(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
    length: int = LENGTH, most: int = MOST,
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): each document's repeated spans and remaining bytes.

    A byte is in a span if a string of ``length`` bytes that covers it also starts
    anywhere else, in this document or another. Strings are judged on the input.
    """
    rows = _rows(documents, doc_id, text)
    copies = written(_copies(rows), "copies")
    spans = _meeting(rows, copies, length, most).mapInArrow(_to_spans(length), _SPANS)
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    copied = copies.groupBy("row").agg(F.lit(True).alias("copied"))
    joined = rows.join(by_row, "row", "left").join(copied, "row", "left")
    span = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("kept", T.BinaryType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in chunks(batches, "text"):
            raw = data.tobytes()
            spans_of, kept = [], []
            for low, high, found, whole in zip(
                offsets[:-1].tolist(), offsets[1:].tolist(),
                part.column(2).to_pylist(), part.column(3).to_pylist(),
            ):
                if whole and high - low >= length:
                    found = [{"first": 0, "last": high - low}]
                pairs = np.array([(s["first"], s["last"]) for s in found or []], np.int64).reshape(-1, 2)
                first, last = merged_spans(pairs[:, 0], pairs[:, 1])
                edges = [0, *np.stack([first, last], axis=1).ravel().tolist(), high - low]
                kept.append(b"".join(raw[low + a : low + b] for a, b in zip(edges[::2], edges[1::2])))
                spans_of.append([{"first": a, "last": b} for a, b in zip(first.tolist(), last.tolist())])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(offsets)), pa.array(spans_of, kind),
                 pa.array(kept, pa.binary())],
                schema.names,
            )

    return joined.select("doc_id", "text", "spans", "copied").mapInArrow(cut, schema)


def repeats_digest(cleaned: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"]))
    return cleaned.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
