"""Phrases whose words keep together, by language, mined level by level.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into
words; a phrase lies within one piece. Every phrase is counted, words included, by double-array
tries of candidates: numpy reads all word places of a slice at once, a byte a level, and
bincounts the accepting states.

Candidates are Apriori-safe: a phrase is one only if both phrases that lack its first or
last word may be frequent, and it may be itself. What may be frequent is kept as one bit
for each of a fixed number of hash buckets, set where the bucket's phrases occur often
enough together; so the filter of a level is broadcast at a fixed size, no frequent phrase
is ever left out, and others that share a bucket are found out by their exact counts.
The texts are read once for each level and once more for the places where candidates begin.
These are told with the longest candidate there, equal ones together with their count, and cut
into slices by a hash of its first two words, so that a task holds whole slices. It filters them
once more, by all bits of a hash, cuts what may still be frequent into tries of a bounded number
of bytes, and reads each place in one of them. So neither passes over the texts nor what a task
holds grow with the number of candidates.

A null text is empty, a null language is ``und``. Texts without words add nothing; an empty
table gives no rows. Repeated rows count again. Ids and other columns are not read.

Keys that many rows share (a common word, a language) are counted on the map side first,
looked up by broadcast where they are heavy, and cut to the rows wanted before a language's
best phrases meet. With far more frequent phrases than buckets the filter lets most
phrases pass, and places are told nearly whole: up to three times the bytes of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchstats.llm.double_array import build, counted
from matchstats.llm.joins import looked_up
from matchstats.llm.tables import written
from matchstats.llm.textbytes import SpanHash, Words, chunks, mixed, powers

MOST_WORDS, LEAST_COUNT, BEST = 3, 10, 2000
#: A candidate goes if a longer one around it has this share of its count, in hundredths.
INSIDE_PERCENT = 50
#: One bit each: the filter of a level takes 8 MB.
BUCKETS = 1 << 26
#: Bytes of keys in a trie, which it exceeds only where hashes are uneven. It has at most one node a
#: byte, and 8 bytes a cell; the task that builds it holds some 100 bytes for each of them.
TRIE_BYTES = 1 << 20
#: Parts of a filter, of 65,536 buckets each, that a task tells in one batch.
_PARTS_AT_ONCE = 32
_TOLD = pa.schema([("part", pa.int64()), ("places", pa.binary()), ("counts", pa.binary())])
#: Keys whose counts are told in one row, and rows of sums that are given at once.
_KEYS_TOLD, _SUMS_AT_ONCE = 1 << 12, 1 << 15
_TOLD_KEYS = pa.schema([("slice", pa.int64()), ("part", pa.int64()), ("lang", pa.string()), *list(_TOLD)[1:]])
#: Bytes of phrases that a task packs at once, about, and phrases that it adds to them at once.
_NAMED_BYTES, _NAMED_AT_ONCE = 8 << 20, 1 << 17
#: Bytes of told places that are read together, about, and the least number of slices they are told in.
_READ_BYTES, _LEAST_PARTS = 8 << 20, 1 << 8
CHUNK = 1 << 19
_UNKNOWN = "und"
_FOLD = np.uint64(0x9E3779B97F4A7C15)
_SPACE, _BREAK = 0x20, 0x0A
_ARRAYS = ("base", "check", "ends", "numbers")

_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAPS = _BREAKS.copy()
_GAPS[[0x20, 0x09]] = True


@cache
def _powers(base: int) -> np.ndarray:
    return powers(np.uint64(base), CHUNK + CHUNK // 4)


class ChunkHash(SpanHash):
    """Hashes of spans of a buffer; the powers for buffers of a chunk's length are kept."""

    def _powers(self, base: int, count: int) -> np.ndarray:
        return _powers(base)[:count] if count <= CHUNK + CHUNK // 4 else super()._powers(base, count)


class Pieces:
    """Words of a chunk, which of them are followed by another in their piece, and languages."""

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        self.words = Words(data, offsets, _GAPS)
        count = len(self.words.starts)
        # Words of a piece have no break between them and belong to one text.
        breaks = np.concatenate([[0], np.cumsum(_BREAKS[data])])
        piece = breaks[self.words.raw_starts]
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.words.first))
        self.joined = np.zeros(count, bool)
        if count:
            self.joined[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        langs = pc.fill_null(rows.column("lang"), _UNKNOWN).dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[text]
        seeds = np.array([_seed(lang) for lang in self.langs], np.uint64)
        self._hashes = ChunkHash(self.words.buffer)(self.words.starts, self.words.ends)
        if count:
            self._hashes = mixed(self._hashes ^ seeds[self.lang])

    def grams(self, size: int) -> np.ndarray:
        """The first words of all phrases of so many words."""
        whole = np.ones(len(self.joined), bool)
        for k in range(size - 1):
            whole &= np.concatenate([self.joined[k:], np.zeros(k, bool)])
        return np.flatnonzero(whole)

    def hashes(self, size: int, of: np.ndarray) -> np.ndarray:
        """Of phrases, from those of their words."""
        hashes = self._hashes[of]
        for k in range(1, size):
            hashes = mixed(hashes * _FOLD + self._hashes[of + k])
        return hashes

    def buckets(self, size: int, of: np.ndarray, buckets: int) -> np.ndarray:
        return self.hashes(size, of) % np.uint64(buckets)

    def phrases(self, size: int, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the phrases that begin there, a line feed behind each, and their lengths."""
        starts, ends = self.words.starts[of], self.words.ends[of + size - 1] + 1
        lengths = ends - starts
        raw = self.words.buffer[_spans(starts, lengths)]
        raw[np.cumsum(lengths) - 1] = _BREAK
        return raw, lengths

    def distinct_words(self) -> tuple[np.ndarray, np.ndarray]:
        """A place of each word of each language, and how often it occurs."""
        if not len(self.joined):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _distinct(np.diff(np.r_[self.words.starts, len(self.words.buffer)]), self.words.buffer, self.lang)


def _values(lengths: np.ndarray, raw: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(lengths)]
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _distinct(
    lengths: np.ndarray, raw: np.ndarray, lang: np.ndarray, times: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """A place of each of the values, which lie one after the other, by language, and how often it occurs."""
    langs = int(lang.max()) + 1
    numbers = _values(lengths, raw).dictionary_encode().indices.to_numpy() * np.int64(langs) + lang
    if numbers.max() > 4 * langs + 4 * len(numbers):
        numbers = pa.array(numbers).dictionary_encode().indices.to_numpy()
    counts = np.bincount(numbers, times).astype(np.int64)
    places = np.zeros(len(counts), np.int64)
    places[numbers] = np.arange(len(numbers))
    met = np.flatnonzero(counts)
    return places[met], counts[met]


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of spans, one span after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


class Named:
    """Phrases that a task has found, packed by part and language."""

    def __init__(self, parts: int = 1 << 9):
        self.bytes = 0
        self._parts = parts
        self._langs: dict[str, int] = {}
        self._found: list[tuple[np.ndarray, ...]] = []

    def add(
        self, pieces: Pieces, size: int, of: np.ndarray, hashes: np.ndarray, times: np.ndarray | None = None
    ) -> None:
        """Their parts go by the hashes; those of single words follow the others."""
        raw, lengths = pieces.phrases(size, of)
        codes = np.array([self._langs.setdefault(lang, len(self._langs)) for lang in pieces.langs], np.int32)
        part = (hashes >> np.uint64(32)) % np.uint64(self._parts) + np.uint64(self._parts * (size == 1))
        times = np.ones(len(of), np.int32) if times is None else times.astype(np.int32)
        self._found.append((part.astype(np.int32), codes[pieces.lang[of]], lengths.astype(np.int32), raw, times))
        self.bytes += len(raw)

    def packed(self) -> pa.RecordBatch:
        """(part, lang, phrases, counts) of all that was added, each phrase once; then it is empty."""
        part, lang, lengths, raw, times = map(np.concatenate, zip(*self._found))
        self._found, self.bytes = [], 0
        places, times = _distinct(lengths, raw, lang, times)
        order = np.lexsort((lang[places], part[places]))
        places, times = places[order], times[order]
        # Arrow moves whole phrases: the place of every byte would take many times their memory.
        data = _values(lengths, raw).take(pa.array(places)).buffers()[2]
        part, lang, lengths = part[places], lang[places], lengths[places]
        edges = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (lang[1:] != lang[:-1]), True])
        ends = np.r_[0, np.cumsum(lengths)][edges].astype(np.int32)
        names = np.array(list(self._langs), object)
        return pa.RecordBatch.from_arrays(
            [pa.array(part[edges[:-1]].astype(np.int64)), pa.array(names[lang[edges[:-1]]], pa.string()),
             pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(ends), data]),
             pa.array([_least_bytes(times[a:b]) for a, b in zip(edges, edges[1:])], pa.binary())],
            ["part", "lang", "phrases", "counts"],
        )


def _least_bytes(counts: np.ndarray) -> bytes:
    """Counts, in as few bytes each as hold them."""
    return counts.astype(np.min_scalar_type(int(counts.max())).newbyteorder("<")).tobytes()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Pieces]:
    for rows, data, offsets in chunks(batches, "text", CHUNK):
        yield Pieces(rows, data, offsets)


def _may_be_frequent(pieces: Pieces, size: int, filters: list, buckets: int) -> np.ndarray:
    """Phrases of the size whose two parts lacking one word pass the filter before."""
    of = pieces.grams(size)
    if size > 1 and len(of):
        bits = filters[size - 2].value
        of = of[_set(bits, pieces.buckets(size - 1, of, buckets))]
        of = of[_set(bits, pieces.buckets(size - 1, of + 1, buckets))]
    return of


def _set(bits: np.ndarray, of: np.ndarray) -> np.ndarray:
    return (bits[(of >> np.uint64(3)).astype(np.int64)] >> (of & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _frequent_buckets(texts: DataFrame, size: int, filters: list, buckets: int, least: int) -> np.ndarray:
    """The filter of a level: buckets / 8 bytes, whatever the texts.

    A task counts in an array of all buckets, each up to ``least``, which is all that has to
    be known of it. It tells its counts in parts: the buckets met and how often, packed. A
    part's tellings are added up as they are read.
    """
    part = 8 * max(1, min(1 << 13, buckets // 8))
    parts = -(-buckets // part)
    kind = np.uint8 if least < 1 << 8 else np.int64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(parts * part, kind)
        for pieces in _pieces(batches):
            of = _may_be_frequent(pieces, size, filters, buckets)
            found, times = np.unique(pieces.buckets(size, of, buckets), return_counts=True)
            held[found] = np.minimum(held[found] + times, least)
        for at in range(0, parts, _PARTS_AT_ONCE):
            told = []
            for number in range(at, min(parts, at + _PARTS_AT_ONCE)):
                counts = held[number * part : (number + 1) * part]
                places = np.flatnonzero(counts)
                if len(places):
                    told.append((number, places.astype("<u2").tobytes(), counts[places].tobytes()))
            if told:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("part", "places", "counts"), row)) for row in told], _TOLD
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            bits = np.packbits(sums >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([bits])], ["part", "bits"])

        now, sums = None, np.zeros(part, np.int64)
        for batch in batches:
            for number, places, counts in zip(*(column.to_pylist() for column in batch.columns)):
                if number != now:
                    if now is not None:
                        yield packed()
                    now, sums = number, np.zeros(part, np.int64)
                sums[np.frombuffer(places, "<u2")] += np.frombuffer(counts, kind)
        if now is not None:
            yield packed()

    told = texts.mapInArrow(count, "part long, places binary, counts binary")
    added = told.repartition("part").sortWithinPartitions("part").mapInArrow(add, "part long, bits binary")
    whole = np.zeros(parts * part // 8, np.uint8)
    for row in added.collect():
        whole[row["part"] * part // 8 : (row["part"] + 1) * part // 8] = np.frombuffer(row["bits"], np.uint8)
    return whole


def _told(texts: DataFrame, sizes: int, filters: list, buckets: int, parts: int) -> DataFrame:
    """(slice, part, lang, places, counts): what begins at the places of the texts, packed.

    A place is told once, with the longest candidate that begins there; shorter ones are its
    beginnings. Its slice goes by its first two words, so that all a candidate's places meet.
    Words that may be frequent are told too, at all their places, in slices of their own.
    Rows without slice count the words of a language.
    """

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, all_words = Named(parts), {}

        def packed() -> pa.RecordBatch:
            rows = found.packed()
            slices, lang, places, counts = rows.columns
            none = pa.array(np.zeros(len(rows), np.int64))
            return pa.RecordBatch.from_arrays([slices, none, lang, places, counts], _TOLD_KEYS.names)

        for pieces in _pieces(batches):
            longest = np.zeros(len(pieces.joined), np.int8)
            for size in range(2, sizes + 1):
                of = _may_be_frequent(pieces, size, filters, buckets)
                longest[of[_set(filters[size - 1].value, pieces.buckets(size, of, buckets))]] = size
            words, times = pieces.distinct_words()
            may = _set(filters[0].value, pieces.buckets(1, words, buckets))
            met = [(size, np.flatnonzero(longest == size), None) for size in range(2, sizes + 1)]
            for size, of, times in [*met, (1, words[may], times[may])]:
                # Also of a text that is far longer than a chunk, not much is held at once.
                for at in range(0, len(of), _NAMED_AT_ONCE):
                    part = slice(at, at + _NAMED_AT_ONCE)
                    hashes = pieces.hashes(min(size, 2), of[part])
                    found.add(pieces, size, of[part], hashes, None if times is None else times[part])
                    if found.bytes > _NAMED_BYTES:
                        yield packed()
            for lang, n in zip(pieces.langs, np.bincount(pieces.lang, minlength=len(pieces.langs)).tolist()):
                all_words[lang] = all_words.get(lang, 0) + n
        if found.bytes:
            yield packed()
        for lang, n in all_words.items():
            yield _told_counts(np.array([n]), None, lang)

    return texts.mapInArrow(tell, "slice long, part long, lang string, places binary, counts binary")


def _counted(told: DataFrame, parts: int, least: int, trie_bytes: int) -> DataFrame:
    """(lang, phrase, words, n): the candidates with n >= least, counted by tries."""
    slices = told.repartition("slice").sortWithinPartitions("slice", "part", "lang")
    return slices.mapInArrow(
        lambda batches: _read(batches, parts, least, trie_bytes), "lang string, phrase string, words int, n long"
    )


def _read(
    batches: Iterator[pa.RecordBatch], parts: int, least: int, trie_bytes: int, read_bytes: int = _READ_BYTES
) -> Iterator[pa.RecordBatch]:
    """Counts of whole slices that come one after the other. Several small ones are read together.

    Of a large slice, places that other tasks told too are put together as they come, so that
    what is held grows with its phrases, not with the texts.
    """
    totals, held, size, most, now = [], {}, 0, 2 * read_bytes, None

    def group() -> Iterator[pa.RecordBatch]:
        for lang, rows in held.items():
            yield from _by_tries(lang, _Places(lang, rows), 1 if now >= parts else 2, least, trie_bytes)

    for batch in batches:
        sliced = batch.column("slice").is_valid()
        if not pc.all(sliced).as_py():
            totals.append(batch.filter(pc.invert(sliced)))
        for number, _, lang, places, counts in zip(*(c.to_pylist() for c in batch.filter(sliced).columns)):
            # Words and longer phrases are not read together: phrases begin with words.
            if number != now and now is not None and (size > read_bytes or (number >= parts) != (now >= parts)):
                yield from group()
                held, size, most = {}, 0, 2 * read_bytes
            now = number
            held.setdefault(lang, []).append((places, counts))
            size += len(places)
            if size > most:
                held = {lang: [_together(rows)] for lang, rows in held.items()}
                size = sum(len(places) for ((places, _),) in held.values())
                most = 2 * max(size, read_bytes)
    yield from group()
    for sums in _summed(iter(totals)):
        yield _frequent(sums.column("lang"), [""] * len(sums), np.zeros(len(sums)), sums.column("n"))


def _together(rows: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
    """Told places as one row, equal ones once with the sum of their counts."""
    raw = np.frombuffer(b"".join(places for places, _ in rows), np.uint8)
    lengths = np.diff(np.r_[0, np.flatnonzero(raw == _BREAK) + 1])
    times = np.concatenate([_unpacked(counts, places.count(_BREAK)) for places, counts in rows])
    places, times = _distinct(lengths, raw, np.zeros(len(lengths), np.int64), times)
    return _values(lengths, raw).take(pa.array(places)).buffers()[2].to_pybytes(), _least_bytes(times)


def _frequent(lang: pa.Array, phrases: list, words: np.ndarray, n: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [lang, pa.array(phrases, pa.string()), pa.array(words.astype(np.int32)), n], ["lang", "phrase", "words", "n"]
    )


class _Places:
    """Told places of a language: phrases one after the other, each with its count."""

    def __init__(self, lang: str, rows: list[tuple[bytes, bytes]]):
        self.buffer = np.frombuffer(b"".join(places for places, _ in rows), np.uint8).copy()
        self.last = self.buffer == _BREAK
        ends = np.flatnonzero(self.last)
        self.starts = np.r_[0, ends[:-1] + 1]
        self.buffer[ends] = _SPACE
        self.spaces = np.flatnonzero(self.buffer == _SPACE)
        #: Where the spaces of each phrase begin, and how many it has: one behind each word.
        self._first = np.searchsorted(self.spaces, self.starts)
        self.words = np.diff(np.r_[self._first, len(self.spaces)])
        self.times = np.concatenate([_unpacked(counts, places.count(_BREAK)) for places, counts in rows])
        self._seed = _seed(lang)

    def ends(self, size: int, of: np.ndarray) -> np.ndarray:
        """Behind the first words of these phrases."""
        return self.spaces[self._first[of] + size - 1] + 1

    def hashes(self, size: int, of: np.ndarray) -> np.ndarray:
        """Of the first words of these phrases."""
        starts, ends = self.starts[of], self.ends(size, of)
        found, at = np.zeros(len(of), np.uint64), 0
        while at < len(of):
            # About a chunk of text at once, as hashing takes many bytes for each.
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, "right")))
            hashed = ChunkHash(self.buffer[starts[at] : ends[stop - 1]])
            found[at:stop] = hashed(starts[at:stop] - starts[at], ends[at:stop] - starts[at])
            at = stop
        return mixed(found ^ self._seed)


def _unpacked(counts: bytes, count: int) -> np.ndarray:
    return np.frombuffer(counts, f"<u{len(counts) // count}").astype(np.int64)


def _by_tries(lang: str, told: _Places, shortest: int, least: int, trie_bytes: int) -> Iterator[pa.RecordBatch]:
    """Frequent beginnings of told phrases, of ``shortest`` words or more, counted by tries.

    Beginnings that share a hash are filtered together once more, so that tries hold little
    but frequent phrases. Tries are cut by the hash of the shortest beginning, so that a
    phrase is read in one of them only.
    """
    keys, of, group = [], np.flatnonzero(told.words >= shortest), np.zeros(len(told.words), np.uint64)
    read = None
    for size in range(shortest, int(told.words.max(initial=0)) + 1):
        of = of[told.words[of] >= size]
        found, first, each = np.unique(told.hashes(size, of), return_index=True, return_inverse=True)
        may = np.bincount(each, told.times[of], len(found)) >= least
        if size == shortest:
            group[of] = found[each]
            read = of[may[each]]
        keys.append((size, of[first[may]]))
        # What begins with a rare phrase is as rare.
        of = of[may[each]]
    key_bytes = sum(int((told.ends(size, named) - told.starts[named]).sum()) for size, named in keys)
    tries = np.uint64(max(1, -(-key_bytes // trie_bytes)))
    group %= tries
    for number in range(int(tries)):
        places = read[group[read] == number]
        if not len(places):
            continue
        named = sorted(
            (told.buffer[a:b].tobytes(), size)
            for size, these in ((size, these[group[these] == number]) for size, these in keys)
            for a, b in zip(told.starts[these].tolist(), told.ends(size, these).tolist())
        )
        phrases = [phrase for phrase, _ in named]
        counts = counted(
            build(phrases), told.buffer, told.starts[places], np.zeros(len(places), np.int32), _SPACE, told.last,
            len(phrases), told.times[places],
        )
        frequent = np.flatnonzero(counts >= least)
        if len(frequent):
            yield _frequent(
                pa.array([lang] * len(frequent), pa.string()), [phrases[k][:-1] for k in frequent],
                np.array([named[k][1] for k in frequent]), pa.array(counts[frequent]),
            )


def _told_counts(counts: np.ndarray, number: int | None, lang: str | None = None) -> pa.RecordBatch:
    """Counts in parts: which keys of the part occur and how often, in as few bytes as hold it."""
    told = []
    for part, at in enumerate(range(0, len(counts), _KEYS_TOLD)):
        held = counts[at : at + _KEYS_TOLD]
        # A language may have no word at all, and is told all the same.
        places = np.flatnonzero(held) if lang is None else np.arange(len(held))
        if len(places):
            told.append((number, part, lang, places.astype("<u2").tobytes(), _least_bytes(held[places])))
    return pa.RecordBatch.from_pylist([dict(zip(_TOLD_KEYS.names, row)) for row in told], _TOLD_KEYS)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slice, number, lang, n) from told parts, those of a key one after the other."""
    now, sums, found = None, np.zeros(_KEYS_TOLD, np.int64), []

    def add_up() -> None:
        number, part, lang = now
        places = np.flatnonzero(sums) if lang is None else np.zeros(1, np.int64)
        found.append(pa.RecordBatch.from_arrays(
            [pa.array([number] * len(places), pa.int64()), pa.array(part * _KEYS_TOLD + places),
             pa.array([lang] * len(places), pa.string()), pa.array(sums[places])],
            ["slice", "number", "lang", "n"],
        ))

    def given() -> pa.RecordBatch:
        whole = pa.Table.from_batches(found).combine_chunks().to_batches()[0]
        found.clear()
        return whole

    for batch in batches:
        for *key, places, counts in zip(*(column.to_pylist() for column in batch.columns)):
            if key != now:
                if now is not None:
                    add_up()
                    if sum(map(len, found)) >= _SUMS_AT_ONCE:
                        yield given()
                now, sums = key, np.zeros(_KEYS_TOLD, np.int64)
            places = np.frombuffer(places, "<u2")
            sums[places] += _unpacked(counts, len(places))
    if now is not None:
        add_up()
        yield given()


def phrase_counts(
    documents: DataFrame, lang: str = "lang", text: str = "text", most_words: int = MOST_WORDS,
    least: int = LEAST_COUNT, buckets: int = BUCKETS, trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """(lang, phrase, words, n): every phrase with n >= least, and the words of such phrases.

    The empty phrase of no words has one row a language that counts all its words.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    filters = []
    for size in range(1, most_words + 1):
        bits = _frequent_buckets(texts, size, filters, buckets, least)
        filters.append(spark.sparkContext.broadcast(bits))
    # Of a place at most so many bytes are told as its phrases have, if all differ.
    text_bytes = texts.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    parts = max(_LEAST_PARTS, most_words * text_bytes // _READ_BYTES)
    told = _told(texts, most_words, filters, buckets, parts)
    counts = written(_counted(told, parts, least, trie_bytes), "phrase-counts")
    for bits in filters:
        bits.unpersist()
    return counts


def _cuts(counts: DataFrame, most_words: int) -> DataFrame:
    """(lang, phrase, a, words, k, left, right): every way to cut a phrase in two."""
    words = F.split("phrase", " ")
    phrases = counts.where("words > 1").select(
        "lang", "phrase", F.col("n").alias("a"), "words", words.alias("_words"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    )
    part = lambda at, n: F.concat_ws(" ", F.slice("_words", at, n))
    return phrases.select(
        "lang", "phrase", "a", "words", "k",
        part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
    )


def _inner(counts: DataFrame) -> DataFrame:
    """(lang, phrase, around): the most frequent longer candidate that a phrase lies in."""
    words = F.split("phrase", " ")
    # All places and lengths of two words on but the whole.
    spans = F.expr(
        "flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), "
        "at -> concat_ws(' ', slice(_words, at, n)))))"
    )
    longer = counts.where("words > 2").select("lang", "n", "words", words.alias("_words"))
    return (
        longer.select("lang", "n", F.explode(spans).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    )


def score_phrases(counts: DataFrame, most_words: int = MOST_WORDS, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score): phrases that lie in no longer one of like frequency.

    ``score`` is floor(1000000 a a / (l r)) for the lowest-scoring cut of the phrase, the
    first of equals. Products take up to 38 digits and are exact for counts under 10^15.
    """
    cuts = written(_cuts(counts, most_words), "cuts")
    of = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
    left = written(looked_up(cuts, of("left", "l"), ["lang", "left"]), "left-counts")
    parts = looked_up(left, of("right", "r"), ["lang", "right"])
    whole = lambda name: F.col(name).cast("decimal(15,0)")
    product = (whole("a") * whole("a") * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(38,0)")
    score = F.call_function("div", product, whole("l") * whole("r"))
    lowest = parts.select("lang", "phrase", "a", "k", "l", "r", score.alias("score")).groupBy(
        "lang", "phrase", "a"
    ).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    alone = lowest.join(_inner(counts), ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < inside_percent * F.col("a"))
    )
    return alone.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def best_collocations(
    documents: DataFrame, best: int = BEST, lang: str = "lang", text: str = "text",
    most_words: int = MOST_WORDS, inside_percent: int = INSIDE_PERCENT, **settings: int,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best, by score, count and text.

    ``n`` counts all words of the language.
    """
    counts = phrase_counts(documents, lang, text, most_words, **settings)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = score_phrases(counts, most_words, inside_percent).withColumn("rank", F.row_number().over(order))
    totals = counts.where("words = 0").select("lang", "n")
    return ranked.where(F.col("rank") <= best).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
