"""Benchmark decontamination: documents that hold a passage of a benchmark item.

Items and documents are word sequences (letters and digits of lower-cased text). Items of
like length share a window length, three quarters of the shortest; every window of an
item gets a SimHash fingerprint, and so does every few words a window of a document, so
few that a copied item always holds a whole one at the alignment of one of its own.

Fingerprints within the radius are found by multi-index blocks: of four 16-bit blocks of
two fingerprints at distance seven or less, one differs in at most one bit, so the items'
blocks are indexed with all their one-bit changes and each document block is one lookup.

Windows miss some passages that lack words, so shingles lead to an item as well. A passage
of the least similarity holds that share of the item's shingle weight; so of an item's
anchors, shingles that weigh more than the rest, it holds one. Every word of a document is
looked up among the anchors, which leaves no passage out, wherever it lies and whatever it
lacks.

Whichever way an item was met, the five-word shingles of passage and item, weighted by how
often they occur, decide: sum of least over sum of most weights, at the best of all places
and lengths in the document.

Items are searched for in blocks of a fixed number, each against all documents, so that
what is sent to the tasks has a fixed bound. Null and empty texts hold and are no
passages; an item of fewer than five words is one shingle. Rows with a null id are
matched like any other. Repeated rows match alike. An empty table matches nothing.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats.llm.tables import with_fields
from matchstats.llm.textbytes import SpanHash, Words, chunks

SHINGLE_WORDS, SIMILARITY, RADIUS = 5, 0.8, 7
WINDOW_SHARE = 0.75
#: Most items, and most bytes of an item, sent to the tasks at once.
ITEMS_AT_ONCE = 2_000
CHUNK_BYTES = 1 << 18

_GAPS = np.ones(256, bool)
_GAPS[0x80:] = False
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    _GAPS[ord(_first) : ord(_last) + 1] = False


@dataclass
class _Class:
    """Items that share a window length."""

    window: int
    stride: int
    prints: np.ndarray = None
    items: np.ndarray = None
    places: np.ndarray = None
    #: For each block: where each value's entries begin in ``entries``.
    begins: list[np.ndarray] = field(default_factory=list)
    entries: list[np.ndarray] = field(default_factory=list)


@dataclass
class BenchmarkIndex:
    ids: list
    lengths: np.ndarray
    shingles: list[dict[int, int]]
    classes: list[_Class]
    #: By shingle length in words: anchors, ascending, and the item of each.
    anchors: dict[int, tuple[np.ndarray, np.ndarray]]
    #: The similarity that the anchors were chosen for.
    similarity: float


def _word_hashes(words: Words) -> np.ndarray:
    return SpanHash(words.buffer)(words.starts, words.ends)


class _Bits:
    """Running counts of each hash bit, for fingerprints of any window of words."""

    def __init__(self, hashes: np.ndarray):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
        self._sums = np.zeros((len(hashes) + 1, 64), np.uint16)
        if len(hashes) < 1 << 16:
            # No count overflows its 16 bits, so four are added up at once.
            four = bits.astype(np.uint16).view(np.uint64)
            np.cumsum(four, axis=0, out=self._sums.view(np.uint64)[1:])
        else:
            # Counts wrap around; differences within a window are right all the same.
            np.cumsum(bits, axis=0, dtype=np.uint16, out=self._sums[1:])

    def prints(self, starts: np.ndarray, window: int) -> np.ndarray:
        most = (self._sums[starts + window] - self._sums[starts]) * 2 > window
        return np.packbits(most, axis=1).view("<u8")[:, 0]


def _shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The shingle from every word on, given by word hashes; those across texts are included."""
    mark = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        mark = mark * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(mark)]
    return mark


def _shingle_counts(hashes: np.ndarray) -> dict[int, int]:
    """Weighted shingles of a passage given by its word hashes."""
    size = min(SHINGLE_WORDS, len(hashes))
    if not size:
        return {}
    values, counts = np.unique(_shingle_hashes(hashes, size), return_counts=True)
    return dict(zip(values.tolist(), counts.tolist()))


def weighted_similarity(
    a: dict[int, int], b: dict[int, int], moved: int = 0
) -> tuple[float, float]:
    """Similarity of weighted shingles, and the most it can be after ``moved`` changes to b."""
    least = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
    most = sum(a.values()) + sum(b.values()) - least
    return least / most if most else 0.0, (least + moved) / max(1, most - moved)


def _anchors(
    shingles: list[dict[int, int]], lengths: np.ndarray, similarity: float
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Of each item the shingles of fewest items, until they weigh more than may be missing."""
    holders = Counter(s for own in shingles for s in own)
    found = defaultdict(list)
    for item, own in enumerate(shingles):
        weight = sum(own.values())
        missing = weight - ceil(similarity * weight - 1e-9)
        for shingle in sorted(own, key=lambda s: (holders[s], s)):
            found[min(SHINGLE_WORDS, int(lengths[item]))].append((shingle, item))
            missing -= own[shingle]
            if missing < 0:
                break
    anchors = {}
    for size, pairs in found.items():
        values, numbers = zip(*sorted(pairs))
        anchors[size] = np.array(values, np.uint64), np.array(numbers)
    return anchors


def best_passage(
    item: dict[int, int], marks: list[int], similarity: float
) -> tuple[float, int, int] | None:
    """(similarity, first, shingles) of the best passage in a text given by its shingles.

    The best passage begins and ends with a shingle of the item, and is no longer than the
    item's weight over the similarity.
    """
    weight = sum(item.values())
    least, most = ceil(similarity * weight - 1e-9), floor(weight / similarity + 1e-9)
    places = [p for p, mark in enumerate(marks) if mark in item]
    stops = np.searchsorted(places, np.array(places, np.int64) + most)
    best, known = None, 0.0
    for k in np.flatnonzero(stops - np.arange(len(places)) >= least).tolist():
        first, left, shared = places[k], {}, 0
        # Were every later shingle of the item shared, up to its weight.
        if min(int(stops[k]) - k, weight) / weight <= known:
            continue
        for place in places[k : int(stops[k])]:
            mark = marks[place]
            rest = left.get(mark, item[mark])
            if rest:
                left[mark], shared = rest - 1, shared + 1
            length = place - first + 1
            alike = shared / (weight + length - shared)
            if alike >= similarity and alike > known:
                best, known = (alike, first, length), alike
        if known == 1.0:
            break
    return best


def index_items(
    items: list[tuple], radius: int = RADIUS, similarity: float = SIMILARITY
) -> BenchmarkIndex:
    """The index over (id, text) of a bounded block of items."""
    raw = [(text or "").encode() for _, text in items]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    words = Words(np.frombuffer(b"".join(raw), np.uint8), offsets, _GAPS)
    hashes, lengths = _word_hashes(words), np.diff(words.first)
    per_item = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
    classes: list[_Class] = []
    rest = np.argsort(lengths, kind="stable")
    rest = rest[lengths[rest] > 0]
    while len(rest):
        shortest = int(lengths[rest[0]])
        window = max(1, int(shortest * WINDOW_SHARE))
        own = rest[lengths[rest] < max(shortest + 1, shortest * 4 // 3)]
        rest = rest[len(own) :]
        made = _Class(window, shortest - window + 1)
        prints, numbers, places = [], [], []
        for item in own:
            starts = np.arange(lengths[item] - window + 1)
            prints.append(_Bits(per_item[item]).prints(starts, window))
            numbers.append(np.full(len(starts), item))
            places.append(starts)
        made.prints, made.items, made.places = map(np.concatenate, (prints, numbers, places))
        changes = np.concatenate([[0], 1 << np.arange(16)]).astype(np.uint16)
        for block in range(4):
            values = made.prints.view("<u2").reshape(-1, 4)[:, block]
            near = (values[:, None] ^ changes).ravel()
            order = np.argsort(near, kind="stable")
            made.begins.append(np.searchsorted(near[order], np.arange((1 << 16) + 1)))
            made.entries.append(order // len(changes))
        classes.append(made)
    shingles = [_shingle_counts(h) for h in per_item]
    anchors = _anchors(shingles, lengths, similarity)
    return BenchmarkIndex([i for i, _ in items], lengths, shingles, classes, anchors, similarity)


def _candidates(made: _Class, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, entry) pairs within the radius, each once."""
    found = []
    for block in range(4):
        values = prints.view("<u2").reshape(-1, 4)[:, block]
        begin, end = made.begins[block][values], made.begins[block][values.astype(np.int64) + 1]
        hit = np.flatnonzero(end > begin)
        counts = (end - begin)[hit]
        window = np.repeat(hit, counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        entry = made.entries[block][np.repeat(begin[hit], counts) + within]
        close = np.bitwise_count(prints[window] ^ made.prints[entry]) <= radius
        found.append(window[close] * len(made.prints) + entry[close])
    pairs = np.unique(np.concatenate(found))
    return pairs // len(made.prints), pairs % len(made.prints)


def _met(
    index: BenchmarkIndex, words: Words, marks: dict[int, np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(texts, items) that share an anchor."""
    for size, (anchors, items) in index.anchors.items():
        here = marks[size]
        if not len(here):
            continue
        # Most shingles are none of the anchors, which a table of their low bits tells.
        table = np.zeros(1 << 16, bool)
        table[anchors.view("<u2")[::4]] = True
        hit = np.flatnonzero(table[here.view("<u2")[::4]])
        begin = np.searchsorted(anchors, here[hit])
        counts = np.searchsorted(anchors, here[hit], "right") - begin
        hit, begin, counts = hit[counts > 0], begin[counts > 0], counts[counts > 0]
        owner = np.searchsorted(words.first, hit, "right") - 1
        inside = hit + size <= words.first[owner + 1]
        owner, begin, counts = owner[inside], begin[inside], counts[inside]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        yield np.repeat(owner, counts), items[np.repeat(begin, counts) + within]


def passages(
    index: BenchmarkIndex,
    data: np.ndarray,
    offsets: np.ndarray,
    radius: int = RADIUS,
    similarity: float = SIMILARITY,
) -> list[tuple[int, int, float, int, int]]:
    """(text, item, similarity, first word, words): the best place of each item in a text."""
    if similarity < index.similarity:
        raise ValueError("the items are indexed for a higher similarity")
    words = Words(data, offsets, _GAPS)
    if not len(words.starts):
        return []
    hashes = _word_hashes(words)
    bits = _Bits(hashes)
    lengths = np.diff(words.first)
    marks = {size: _shingle_hashes(hashes, size) for size in index.anchors}
    pairs: set[tuple[int, int]] = set()
    for texts, items in _met(index, words, marks):
        pairs.update(zip(texts.tolist(), items.tolist()))
    for made in index.classes:
        counts = np.maximum(0, (lengths - made.window) // made.stride + 1)
        owner = np.repeat(np.arange(len(lengths)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = words.first[:-1][owner] + within * made.stride
        if not len(starts):
            continue
        window, entry = _candidates(made, bits.prints(starts, made.window), radius)
        pairs.update(zip(owner[window].tolist(), made.items[entry].tolist()))
    found, held, listed = [], None, {}
    for text, item in sorted(pairs):
        size = min(SHINGLE_WORDS, int(index.lengths[item]))
        if text != held:
            held, listed = text, {}
        if size not in listed:
            low, high = int(words.first[text]), int(words.first[text + 1])
            listed[size] = marks[size][low : max(low, high - size + 1)].tolist()
        best = best_passage(index.shingles[item], listed[size], similarity)
        # A shorter shingle is one only where it is the whole passage.
        if best and (size == SHINGLE_WORDS or best[2] == 1):
            found.append((text, item, best[0], best[1], best[2] + size - 1))
    return found


def _item_blocks(benchmark: DataFrame, item_id: str, text: str, at_once: int) -> Iterator[list[tuple]]:
    """The items, block by block, each of about ``at_once``."""
    count = benchmark.count()
    blocks = max(1, -(-count // at_once))
    for block in range(blocks):
        rows = benchmark.where(
            F.pmod(F.xxhash64(item_id, text), F.lit(blocks)) == block
        ).select(item_id, text)
        yield [tuple(r) for r in rows.collect()]


def find_passages(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    radius: int = RADIUS,
    similarity: float = SIMILARITY,
    at_once: int = ITEMS_AT_ONCE,
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): passages of items in documents."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item"))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            items.schema["item_id"],
            T.StructField("similarity", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("n_words", T.LongType()),
        ]
    )
    types = [pa.float64(), pa.int64(), pa.int64()]

    def search(index: BenchmarkIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, data, offsets in chunks(batches, "text", CHUNK_BYTES):
                found = passages(index, data, offsets, radius, similarity)
                if not found:
                    continue
                texts, numbers, *rest = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(texts)),
                        pa.array([index.ids[i] for i in numbers]),
                        *(pa.array(values, kind) for values, kind in zip(rest, types)),
                    ],
                    schema.names,
                )

        return run

    result = None
    for block in _item_blocks(items, "item_id", "item", at_once):
        found = rows.mapInArrow(search(index_items(block, radius, similarity)), schema)
        result = found if result is None else result.unionByName(found)
    return result


def without_passages(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    radius: int = RADIUS,
    similarity: float = SIMILARITY,
    at_once: int = ITEMS_AT_ONCE,
) -> DataFrame:
    """The documents that hold no passage of any item, in one pass without a shuffle."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item"))

    def keep(index: BenchmarkIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, data, offsets in chunks(batches, text, CHUNK_BYTES):
                clean = np.ones(part.num_rows, bool)
                clean[[f[0] for f in passages(index, data, offsets, radius, similarity)]] = False
                yield part.filter(pa.array(clean))

        return run

    for block in _item_blocks(items, "item_id", "item", at_once):
        documents = documents.mapInArrow(keep(index_items(block, radius, similarity)), documents.schema)
    return documents
