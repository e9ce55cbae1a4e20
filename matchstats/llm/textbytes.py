"""Texts of a record batch as flat numpy arrays of bytes, words and shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words are runs of anything but space and the control characters 9 to 13.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
CHUNK_BYTES, CHUNK_ROWS = 1 << 20, 1 << 12


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: none) one after the other, and the offset of each."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, most: int = CHUNK_BYTES, rows: int = CHUNK_ROWS
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches: at most ``rows``, of ``most`` bytes of text if over one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, ends = text_bytes(batch.column(batch.schema.get_field_index(text)))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
            stop = min(stop, row + rows)
            offsets = ends[row : stop + 1]
            yield batch.slice(row, stop - row), data[offsets[0] : offsets[-1]], offsets - offsets[0]
            row = stop


def with_columns(
    text: str, compute: Callable[[np.ndarray, np.ndarray], list[pa.Array]], names: list[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that adds computed columns to every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text):
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *compute(data, offsets)], [*rows.schema.names, *names]
            )

    return run


class Words:
    """The words of a chunk in one buffer, lower case, a space after each.

    ``starts`` and ``ends`` are places in ``buffer``; text ``i`` owns the words
    ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE):
        inside = ~gaps[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[False], inside[:-1]])[: len(data)]
        after = np.concatenate([inside[1:], [False]])[: len(data)]
        begins = np.flatnonzero(inside & (~before | edge[:-1]))
        stops = np.flatnonzero(inside & (~after | edge[1:])) + 1
        lengths = stops - begins
        self.raw_starts, self.raw_ends = begins, stops
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        self.buffer = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
        held = np.ones(len(self.buffer), bool)
        held[self.ends] = False
        self.buffer[held] = _LOWER[data[inside]]
        self.first = np.searchsorted(begins, offsets)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each shingle, and the offsets of each text's shingles.

        A text with fewer words has its whole sequence as one; without words, none.
        """
        words = np.diff(self.first)
        counts = np.where(words >= size, words - size + 1, (words > 0).astype(np.int64))
        offsets = np.concatenate([[0], np.cumsum(counts)])
        within = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts)
        head = np.repeat(self.first[:-1], counts) + within
        last = head + np.repeat(np.minimum(words, size), counts) - 1
        return self.starts[head], self.ends[last], offsets


def powers(base: np.uint64, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    if count:
        powers[0] = 1
    return np.multiply.accumulate(powers)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * _MIX
    values = values ^ (values >> np.uint64(32))
    values = values * _MIX
    return values ^ (values >> np.uint64(32))


class SpanHash:
    """64-bit polynomial hashes of any spans of a buffer, from one pass over it."""

    def __init__(self, buffer: np.ndarray, multiplier: int = int(_MULTIPLIER)):
        inverse = pow(multiplier, -1, 1 << 64)
        terms = (buffer.astype(np.uint64) + np.uint64(1)) * self._powers(multiplier, len(buffer))
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self._back = self._powers(inverse, len(buffer) + 1)

    def _powers(self, base: int, count: int) -> np.ndarray:
        return powers(np.uint64(base), count)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._back[starts])


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every place; windows crossing texts are included."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    have, width, hashes = 0, 1, data.astype(np.uint64) + np.uint64(1)
    done = None
    base, rest = int(_MULTIPLIER), size
    while True:
        if rest & 1:
            if done is None:
                done, have = hashes, width
            else:
                count = len(data) - have - width + 1
                scale = np.uint64(pow(int(_MULTIPLIER), width, 1 << 64))
                done = done[:count] * scale + hashes[have : have + count]
                have += width
        rest >>= 1
        if not rest:
            return mixed(done[: len(data) - size + 1])
        hashes = hashes[:-width] * np.uint64(base) + hashes[width:]
        width *= 2
        base = base * base % (1 << 64)


def hex_strings(values: np.ndarray) -> pa.Array:
    """16 lowercase hex digits for each 64-bit value."""
    digits = np.frombuffer(values.astype(">u8").tobytes().hex().encode(), np.uint8)
    ends = np.arange(len(values) + 1, dtype=np.int32) * 16
    return pa.StringArray.from_buffers(len(values), pa.py_buffer(ends), pa.py_buffer(digits))


def bit_majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each group, the bits set in over half of its hashes; no hashes: zero."""
    result = np.zeros(len(offsets) - 1, np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.add.reduceat(bits, offsets[:-1][full], axis=0, dtype=np.int32)
        most = sums * 2 > np.diff(offsets)[full][:, None]
        result[full] = np.packbits(most, axis=1).view("<u8")[:, 0]
    return result
