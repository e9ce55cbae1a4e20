"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all of it. Learned filters slide over
the embedded bytes of a chunk; each filter's highest answer in a chunk is kept. The mean
and the maximum of these over the chunks give one probability.

Empty and null texts are scored as one chunk of padding. Without labelled rows of both
classes there is no model, and every score is 0.5. Repeated rows score alike; all rows
and columns are kept, added columns get an underscore where a name is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats.llm.labelled import sampled_ids
from matchstats.llm.tables import free_name, held_out, with_fields
from matchstats.llm.textbytes import chunks

CHUNK, OVERLAP = 512, 64
FILTERS, WIDTH, STRIDE, EMBEDDING = 24, 16, 4, 4
PADDING = 256
#: Fitting stays bounded: at most so many rows of each class, none of over TRAIN_BYTES.
#: Scoring reads texts of any length, whole.
ROWS_PER_CLASS, TRAIN_BYTES = 1_200, 1 << 15
#: Passes over the sample, more where it is small; rows in a step; largest step.
EPOCHS, LEAST_STEPS, DOCS_AT_ONCE, RATE = 14, 500, 48, 0.01
THRESHOLD = 0.7
CHUNKS_AT_ONCE = 512


def chunked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts (rows of byte numbers, padded) and each text's first chunk."""
    lengths = np.diff(offsets)
    step = CHUNK - OVERLAP
    counts = 1 + np.maximum(0, -(-(lengths - CHUNK) // step))
    first = np.concatenate([[0], np.cumsum(counts)])
    within = np.arange(first[-1]) - np.repeat(first[:-1], counts)
    begin = np.repeat(offsets[:-1], counts) + within * step
    places = begin[:, None] + np.arange(CHUNK)
    inside = places < np.repeat(offsets[1:], counts)[:, None]
    held = np.full(places.shape, PADDING, np.uint16)
    held[inside] = data[places[inside]]
    return held, first


@dataclass
class QualityModel:
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    on_mean: np.ndarray
    on_most: np.ndarray
    offset: np.ndarray

    def answers(self, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's highest answer in each chunk, and where it is."""
        embedded = self.embedding[held].reshape(len(held), -1)
        places = (CHUNK - WIDTH) // STRIDE + 1
        size = embedded.itemsize
        windows = np.lib.stride_tricks.as_strided(
            embedded,
            (len(held), places, WIDTH * EMBEDDING),
            (embedded.strides[0], STRIDE * EMBEDDING * size, size),
        )
        flat = np.ascontiguousarray(windows).reshape(-1, WIDTH * EMBEDDING)
        answers = (flat @ self.filters).reshape(len(held), places, FILTERS)
        best = answers.argmax(axis=1)
        return np.take_along_axis(answers, best[:, None], axis=1)[:, 0], best

    def logits(self, pooled: np.ndarray, first: np.ndarray) -> np.ndarray:
        counts = np.diff(first)[:, None]
        mean = np.add.reduceat(pooled, first[:-1], axis=0) / counts
        most = np.maximum.reduceat(pooled, first[:-1], axis=0)
        return mean @ self.on_mean + most @ self.on_most + self.offset[0]

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        held, first = chunked(data, offsets)
        pooled = np.vstack(
            [
                np.maximum(self.answers(held[i : i + CHUNKS_AT_ONCE])[0] + self.bias, 0)
                for i in range(0, len(held), CHUNKS_AT_ONCE)
            ]
        )
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled, first), -30, 30)))


def train(texts: list[bytes], labels: np.ndarray, seed: int = 0) -> QualityModel:
    """Fits the network by gradient steps (Adam) over small groups of whole samples."""
    rng = np.random.default_rng(seed)
    model = QualityModel(
        rng.normal(0, 0.5, (PADDING + 1, EMBEDDING)).astype(np.float32),
        rng.normal(0, 0.2, (WIDTH * EMBEDDING, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, FILTERS).astype(np.float32),
        rng.normal(0, 0.1, FILTERS).astype(np.float32),
        np.zeros(1, np.float32),
    )
    names = ["embedding", "filters", "bias", "on_mean", "on_most", "offset"]
    moments = {n: [np.zeros_like(getattr(model, n)), np.zeros_like(getattr(model, n))] for n in names}
    # Both classes count alike, whatever their numbers.
    shares = np.where(labels == 1, labels.mean(), 1 - labels.mean())
    weights = (0.5 / shares).astype(np.float32)
    step, in_pass = 0, -(-len(texts) // DOCS_AT_ONCE)
    passes = max(EPOCHS, -(-LEAST_STEPS // in_pass))
    steps = passes * in_pass
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), DOCS_AT_ONCE):
            step += 1
            chosen = order[at : at + DOCS_AT_ONCE]
            rows = [texts[i] for i in chosen]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in rows])])
            held, first = chunked(np.frombuffer(b"".join(rows), np.uint8), offsets)
            slopes = _slopes(model, held, first, labels[chosen], weights[chosen])
            for name, slope in zip(names, slopes):
                mean, spread = moments[name]
                mean += 0.1 * (slope - mean)
                spread += 0.01 * (slope * slope - spread)
                scale = RATE * (1 - step / steps) / (1 - 0.9**step)
                value = getattr(model, name)
                value -= scale * mean / (np.sqrt(spread / (1 - 0.99**step)) + 1e-7)
    return model


def _slopes(
    model: QualityModel, held: np.ndarray, first: np.ndarray, labels: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Gradients of the weighted mean log loss by each part of the model."""
    answers, best = model.answers(held)
    pooled = np.maximum(answers + model.bias, 0)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    mean = np.add.reduceat(pooled, first[:-1], axis=0) / counts[:, None]
    most = np.maximum.reduceat(pooled, first[:-1], axis=0)
    score = mean @ model.on_mean + most @ model.on_most + model.offset[0]
    error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels) * weights / len(labels)
    error = error.astype(np.float32)
    from_mean = (error / counts)[owner][:, None] * model.on_mean
    is_most = pooled >= most[owner]
    back = from_mean + is_most * error[owner][:, None] * model.on_most
    back = (back * (pooled > 0)).astype(np.float32)

    # Only the place with the highest answer passes anything back.
    places = (best * STRIDE)[:, :, None] + np.arange(WIDTH)
    taken = held[np.arange(len(held))[:, None, None], places]
    patches = model.embedding[taken].reshape(len(held), FILTERS, -1)
    filters = np.einsum("cf,cfk->kf", back, patches, optimize=True)
    to_bytes = (back[:, :, None] * model.filters.T).reshape(-1, EMBEDDING)
    flat = taken.reshape(-1)
    embedding = np.stack(
        [np.bincount(flat, to_bytes[:, e], PADDING + 1) for e in range(EMBEDDING)], axis=1
    ).astype(np.float32)
    return embedding, filters, back.sum(axis=0), error @ mean, error @ most, np.array([error.sum()])


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    rows_per_class: int = ROWS_PER_CLASS,
    seed: int = 0,
) -> QualityModel | None:
    """Learns from labelled documents that are not held out, of both classes."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).alias("quality"))
    known = known.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    sample = dict(sampled_ids(known, "quality", rows_per_class, 2))
    if len(set(sample.values())) < 2:
        return None
    rows = (
        documents.where(F.col(doc_id).isin(list(sample)))
        .select(
            F.col(doc_id).alias("doc_id"),
            F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("raw"),
        )
        .where(F.octet_length("raw") <= TRAIN_BYTES)
        .orderBy("doc_id", "raw")
        .limit(2 * len(sample))
        .collect()
    )
    if len({sample[r["doc_id"]] for r in rows}) < 2:
        return None
    return train(
        [bytes(r["raw"]) for r in rows],
        np.array([sample[r["doc_id"]] for r in rows], np.float32),
        seed,
    )


def score_quality(
    documents: DataFrame, model: QualityModel | None, text: str = "text"
) -> DataFrame:
    """Adds ``score``: the probability of high quality."""
    score = free_name(documents, "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text):
            scores = (
                np.full(len(offsets) - 1, 0.5) if model is None else model.scores(data, offsets)
            )
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(scores.astype(float))], [*rows.schema.names, score]
            )

    return documents.mapInArrow(run, with_fields(documents, **{score: T.DoubleType()}))


def accepted(documents: DataFrame, model: QualityModel | None, text: str = "text") -> DataFrame:
    """The documents scored at the threshold or above; without a model, all of them."""
    if model is None:
        return documents
    score = free_name(documents, "score")
    return score_quality(documents, model, text).where(F.col(score) >= THRESHOLD).drop(score)
