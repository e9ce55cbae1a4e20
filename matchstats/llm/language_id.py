"""Language identification by the nearest of several centroids per language.

A text's vector counts the 1- to 3-byte grams of its letters (any other ASCII character
is a gap), hashed into a fixed number of cells, damped by logarithm, weighted by inverse
document frequency and scaled to length one. The frequencies are counted over all training
rows; the clusters are made from a bounded sample of each language, in a task of its own.
Each language has several centroids, clusters of its training vectors; the nearest by
cosine gives the language. A text with no letter, or farther from every centroid than the
limit, is rejected as ``und``. A model holds all languages there are, 32 KB for each.

Nulls, empty texts and texts without letters are ``und`` with score 0. Whole texts are
read. Ties go to the first language by name. Without training rows everything is
``und``. Repeated rows are predicted alike, and rows equal in language, id and text are one
training row; all rows and columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats.llm.tables import free_name, held_out, with_fields, written
from matchstats.llm.textbytes import chunks

UNDETERMINED = "und"
CELLS = 2048
#: Most training rows of a language, so that fitting stays bounded.
ROWS_PER_LANGUAGE = 600
CLUSTERS = 4
#: A language's rows are sampled in so many parts first.
SAMPLE_PARTS = 64
#: A sample of more rows meets the texts in a shuffle.
SMALL_SAMPLE = 200_000
ROWS_AT_ONCE = 512

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:0x80] = 0x20
for _first, _last in (("a", "z"), ("A", "Z")):
    for _code in range(ord(_first), ord(_last) + 1):
        _FOLD[_code] = _code | 0x20


def gram_counts(data: np.ndarray, offsets: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """For each text, how often its grams fall into each cell (texts x cells)."""
    texts = len(offsets) - 1
    folded = _FOLD[data].astype(np.uint32)
    row = np.repeat(np.arange(texts, dtype=np.int64), np.diff(offsets)) * cells
    last = np.repeat(offsets[1:], np.diff(offsets))
    counts = np.zeros(texts * cells, np.int64)
    value, blank = np.zeros(len(folded), np.uint32), folded == 0x20
    for size in (1, 2, 3):
        count = max(0, len(folded) - size + 1)
        value = value[:count] * np.uint32(257) + folded[size - 1 :]
        kept = np.arange(size, count + size) <= last[:count]
        # A gap alone says nothing, nor what starts with two.
        kept &= ~blank[:count] if size == 1 else ~(blank[:count] & blank[1 : count + 1])
        cell = ((value * np.uint32(0x9E3779B1) + np.uint32(size)) >> np.uint32(15)) % cells
        counts += np.bincount(row[:count][kept] + cell[kept], minlength=len(counts))
    return counts.reshape(texts, cells)


def _damped(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.log1p(counts).astype(np.float32) * idf
    lengths = np.linalg.norm(weights, axis=1, keepdims=True)
    return weights / np.where(lengths > 0, lengths, 1)


def _clusters(vectors: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Spherical k-means from spread-out starts."""
    rng = np.random.default_rng(seed)
    centers = vectors[rng.integers(len(vectors))][None]
    while len(centers) < min(count, len(vectors)):
        nearest = (vectors @ centers.T).max(axis=1)
        centers = np.vstack([centers, vectors[nearest.argmin()][None]])
    for _ in range(20):
        own = (vectors @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, vectors)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centers)
    return centers


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owners: np.ndarray

    def scores(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest language (its number) and cosine for each row of counts."""
        near = _damped(counts, self.idf) @ self.centroids.T
        best = near.argmax(axis=1)
        return self.owners[best], np.clip(near[np.arange(len(near)), best], 0, 1)


def inverse_frequencies(rows: DataFrame, text: str = "text") -> np.ndarray:
    """Weight of each cell over all texts; one short row for each cell reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last cell counts the texts themselves.
        held = np.zeros(CELLS + 1, np.int64)
        for _, data, offsets in chunks(batches, text, rows=ROWS_AT_ONCE):
            held[:-1] += (gram_counts(data, offsets) > 0).sum(axis=0)
            held[-1] += len(offsets) - 1
        full = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), pa.array(held[full])], ["cell", "texts"]
        )

    counted = rows.select(text).mapInArrow(count, "cell int, texts long")
    held = np.zeros(CELLS + 1, np.int64)
    for row in counted.groupBy("cell").agg(F.sum("texts").alias("texts")).collect():
        held[row["cell"]] = row["texts"]
    return np.log((1 + held[-1]) / (1 + held[:-1])).astype(np.float32) + 1


def _sampled(rows: DataFrame, rows_per_language: int) -> DataFrame:
    """(lang, doc_id, mark): at most so many different rows of each language, by a hash.

    Every row is as likely, and the sample depends on the rows only.
    """
    different = rows.where(F.col("doc_id").isNotNull()).select("lang", "doc_id", "mark").distinct()
    drawn = different.withColumn("draw", F.xxhash64("lang", "doc_id", "mark"))
    drawn = drawn.withColumn("part", F.pmod("draw", F.lit(SAMPLE_PARTS)))
    for groups in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*groups).orderBy("draw", "doc_id", "mark")
        drawn = drawn.withColumn("at", F.row_number().over(order)).where(F.col("at") <= rows_per_language)
    return written(drawn.select("lang", "doc_id", "mark"), "language-sample")


def _language_centroids(idf: np.ndarray, clusters: int, seed: int):
    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("mark", "ascending")])
        counts = np.array([np.frombuffer(c, "<i4") for c in rows.column("counts").to_pylist()])
        counts = counts[counts.sum(axis=1) > 0]
        found = _clusters(_damped(counts, idf), clusters, seed) if len(counts) else []
        return pa.table(
            {
                "lang": pa.array([rows.column("lang")[0].as_py()] * len(found), pa.string()),
                "number": pa.array(range(len(found)), pa.int32()),
                "centroid": pa.array([c.astype("<f4").tobytes() for c in found], pa.binary()),
            }
        )

    return fit


def fit_languages(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    clusters: int = CLUSTERS,
    seed: int = 0,
) -> LanguageModel | None:
    """Learns from rows with a language that are not held out; none of them: no model."""
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    marked = rows.withColumn("mark", F.xxhash64("text"))
    sample = _sampled(marked, rows_per_language)
    size = sample.count()
    if not size:
        return None

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, "text", rows=ROWS_AT_ONCE):
            counts = np.minimum(gram_counts(data, offsets), 2**31 - 1).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([c.tobytes() for c in counts], pa.binary())],
                ["lang", "doc_id", "mark", "counts"],
            )

    few = F.broadcast(sample) if size <= SMALL_SAMPLE else sample
    keys = ["lang", "doc_id", "mark"]
    texts = marked.join(few, keys).select(*keys, "text")
    counted = texts.mapInArrow(
        vectors, T.StructType([*texts.schema.fields[:3], T.StructField("counts", T.BinaryType())])
    )
    different = counted.groupBy(*keys).agg(F.first("counts").alias("counts"))
    idf = inverse_frequencies(rows)
    found = different.groupBy("lang").applyInArrow(
        _language_centroids(idf, clusters, seed), "lang string, number int, centroid binary"
    )
    centroids = sorted(found.collect(), key=lambda r: (r["lang"], r["number"]))
    if not centroids:
        return None
    languages = sorted({r["lang"] for r in centroids})
    owners = np.array([languages.index(r["lang"]) for r in centroids])
    return LanguageModel(
        languages, idf, np.array([np.frombuffer(r["centroid"], "<f4") for r in centroids]), owners
    )


def identify_languages(
    documents: DataFrame,
    model: LanguageModel | None,
    text: str = "text",
    least_cosine: float = 0.0,
) -> DataFrame:
    """Adds (lang_pred, score): the nearest language and its cosine, or the rejection.

    ``least_cosine`` is the distance limit: a text below it is ``und``.
    """
    predicted, score = free_name(documents, "lang_pred"), free_name(documents, "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text, rows=ROWS_AT_ONCE):
            raw = data.tobytes()
            letters = np.array(
                [
                    bool(_LETTER.search(raw[a:b].decode("utf-8", "replace")))
                    for a, b in zip(offsets[:-1], offsets[1:])
                ]
            )
            if model is None:
                owners, near = np.zeros(len(letters), int), np.zeros(len(letters))
                letters[:] = False
            else:
                owners, near = model.scores(gram_counts(data, offsets))
            known = letters & (near >= least_cosine)
            names = np.array([*(model.languages if model else []), UNDETERMINED], object)
            languages = pa.array(names[np.where(known, owners, len(names) - 1)], pa.string())
            scores = pa.array(np.where(letters, near, 0).astype(float))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, languages, scores], [*rows.schema.names, predicted, score]
            )

    schema = with_fields(documents, **{predicted: T.StringType(), score: T.DoubleType()})
    return documents.mapInArrow(run, schema)
