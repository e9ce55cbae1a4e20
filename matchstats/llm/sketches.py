"""Document fingerprints: threshold-scaled sketches.

A sketch holds every shingle hash of a text below a fixed fraction of the hash range, the
same for all texts. Sketches of parts merge by union, and the share of one sketch's hashes
that another holds estimates containment, however unequal the documents. Shingles are runs
of 16 bytes of the text as it is; their hashes are kept to 40 bits. A text with no hash
below the fraction, as happens to short ones, is known by its smallest hash; that merges
too. So different short texts differ, but whether one lies in a longer text can't be told.

A fingerprint is text: the fraction's denominator, a colon, and the sorted hashes, five
bytes each, in base 64. Equal texts have equal fingerprints. A null text counts as empty;
texts shorter than a shingle are one shingle, empty texts have an empty sketch. Likeness is
the share of the smaller sketch found in the larger; two empty sketches are alike (1), an
empty and a filled one are not (0).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats.llm.tables import free_name
from matchstats.llm.textbytes import SpanHash, chunks, window_hashes

SHINGLE_BYTES, FRACTION = 16, 8
HASH_BITS = 40


def _shortened(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - HASH_BITS)


class Sketches:
    """Sketches of the texts of a chunk: sorted distinct hashes, one text after the other."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fraction: int = FRACTION):
        self.fraction = fraction
        texts, lengths = len(offsets) - 1, np.diff(offsets)
        counts = np.maximum(0, lengths - SHINGLE_BYTES + 1)
        hashes = _shortened(window_hashes(data, SHINGLE_BYTES))
        places = np.flatnonzero(hashes < _limit(fraction))
        owner = np.searchsorted(offsets, places, "right") - 1
        whole = places + SHINGLE_BYTES <= offsets[owner + 1]
        owner, values = owner[whole], hashes[places[whole]]
        none = np.flatnonzero((counts > 0) & (np.bincount(owner, minlength=texts) == 0))
        if len(none):
            # Every other stretch lies between two such texts.
            edges = np.stack([offsets[:-1][none], offsets[:-1][none] + counts[none]], axis=1).ravel()
            least = np.minimum.reduceat(np.append(hashes, np.uint64(0)), edges)[::2]
            owner, values = np.concatenate([owner, none]), np.concatenate([values, least])
        tiny = np.flatnonzero((lengths > 0) & (counts == 0))
        if len(tiny):
            alone = _shortened(SpanHash(data)(offsets[tiny], offsets[tiny + 1]))
            owner, values = np.concatenate([owner, tiny]), np.concatenate([values, alone])
        order = np.lexsort((values, owner))
        owner, values = owner[order], values[order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
        self.values = values[fresh]
        self.offsets = np.searchsorted(owner[fresh], np.arange(texts + 1))

    def of(self, text: int) -> tuple[int, np.ndarray]:
        return self.fraction, self.values[self.offsets[text] : self.offsets[text + 1]]


def _limit(fraction: int) -> np.uint64:
    return np.uint64((1 << HASH_BITS) // fraction)


def _below(values: np.ndarray, fraction: int) -> np.ndarray:
    """Of sorted hashes those below the fraction, the smallest if there is none."""
    return values[: max(1, int(np.searchsorted(values, _limit(fraction), "left")))]


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Share of the smaller sketch found in the larger, at the lower fraction of the two."""
    fraction = max(a[0], b[0])
    left, right = _below(a[1], fraction), _below(b[1], fraction)
    if not len(left) or not len(right):
        return float(len(left) == len(right))
    return len(np.intersect1d(left, right, assume_unique=True)) / min(len(left), len(right))


def merged(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
    """The sketch of two texts together."""
    fraction = max(a[0], b[0])
    return fraction, _below(np.union1d(a[1], b[1]), fraction)


def to_text(sketch: tuple[int, np.ndarray]) -> str:
    raw = sketch[1].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BITS // 8 :]
    return f"{sketch[0]}:{base64.b64encode(raw.tobytes()).decode()}"


def from_text(fingerprint: str) -> tuple[int, np.ndarray]:
    fraction, digits = fingerprint.split(":")
    raw = np.frombuffer(base64.b64decode(digits), np.uint8).reshape(-1, HASH_BITS // 8)
    padded = np.pad(raw, ((0, 0), (8 - HASH_BITS // 8, 0)))
    return int(fraction), padded.view(">u8")[:, 0].astype(np.uint64)


def sketch_documents(documents: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of each whole text, under a free name; rows and columns are kept."""
    name = free_name(documents, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text):
            found = Sketches(data, offsets)
            prints = pa.array([to_text(found.of(i)) for i in range(len(offsets) - 1)], pa.string())
            yield pa.RecordBatch.from_arrays([*rows.columns, prints], [*rows.schema.names, name])

    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.StringType())])
    return documents.mapInArrow(run, schema)


_RESULT = (
    "doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _sketched(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    found = Sketches(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return [found.of(i) for i in range(len(texts))]


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids: list, texts: list[str], kind: pa.DataType) -> pa.RecordBatch:
    """Results for each text but the last, which is only the next of the one before it."""
    edited = [_edited(a, b) for a, b in zip(texts, texts[1:])]
    own, changed = _sketched(texts), _sketched(edited)
    count = len(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[:count], kind),
            pa.array([len(t) for t in texts[:count]], pa.int64()),
            pa.array(
                [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                pa.string(),
            ),
            pa.array([to_text(s) for s in own[:count]], pa.string()),
            pa.array([to_text(s) for s in changed], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(own, changed)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, own[1:])], pa.float64()),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def next_document_likeness(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", partitions: int | None = None
) -> DataFrame:
    """How sketches see an edit: each text, its half replaced from the next document, and that one.

    The next document is the next by descending id (null ids last, ties by a hash of the
    text), after the last the first. Texts are range-partitioned by that order once; each partition looks
    one row ahead, and only the first and last row of each partition meet in a second,
    small step. A single document is its own next one.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")
    )
    # Range boundaries are drawn from a sample of these, so no text is among them.
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    schema = _RESULT.format(id=rows.schema["doc_id"].dataType.simpleString())

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids, held_texts = [], []
        for part, _, offsets in chunks(batches, "text", 1 << 19):
            ids = held_ids + part.column(0).to_pylist()
            texts = held_texts + part.column(1).to_pylist()
            if len(texts) > 1:
                yield _compared(ids, texts, part.schema.field(0).type)
            held_ids, held_texts = ids[-1:], texts[-1:]

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first and the last row of the partition in one row."""
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = first or batch.slice(0, 1)
                last = batch.slice(batch.num_rows - 1, 1)
        if first is not None:
            yield pa.RecordBatch.from_arrays(
                [*first.columns, *last.columns], ["first_id", "first_text", "last_id", "last_text"]
            )

    kind = rows.schema["doc_id"].dataType
    ends = placed.mapInArrow(
        edges,
        T.StructType(
            [
                T.StructField("first_id", kind),
                T.StructField("first_text", T.StringType()),
                T.StructField("last_id", kind),
                T.StructField("last_text", T.StringType()),
            ]
        ),
    ).withColumn("place", F.spark_partition_id())
    # One narrow row for each partition says which partition follows; the last is followed
    # by the first.
    places = ends.select("place")
    following = places.select(
        "place",
        F.coalesce(
            F.lead("place").over(Window.orderBy("place")), F.min("place").over(Window.partitionBy())
        ).alias("following"),
    )
    firsts = ends.select(F.col("place").alias("following"), "first_text")
    joined = (
        ends.select("place", "last_id", "last_text")
        .join(following.hint("merge"), "place")
        .join(firsts.hint("merge"), "following")
        .select(F.col("last_id").alias("doc_id"), F.col("last_text").alias("text"), "first_text")
    )

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, text_one, text_next in zip(*(c.to_pylist() for c in batch.columns)):
                yield _compared([one, None], [text_one, text_next], batch.schema.field(0).type)

    return placed.mapInArrow(inside, schema).unionByName(joined.mapInArrow(across, schema))
