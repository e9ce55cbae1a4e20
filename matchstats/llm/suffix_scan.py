"""Suffix arrays of anchored places: the numpy side of repeat removal.

Anchors are places chosen by content: wherever a string of ``length`` bytes occurs, the
same place in it is an anchor, the one whose ``GRAM`` bytes have the least hash in the
string. So both occurrences of a repeated string hold an anchor with equal bytes, and
only anchors need sorting, about one in eighty places.

The suffixes at anchors with equal bytes are sorted, with the common prefix of each two
neighbours. A scan with a stack finds the tree of common-prefix intervals. In each
interval, the bytes before the anchors, read backwards, are sorted likewise: its own
intervals, as far as their suffixes differ too, are maximal repeats with all their
occurrences, since they can be extended neither way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from matchstats.llm.textbytes import SpanHash, window_hashes

GRAM = 32


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``width`` neighbouring values."""
    have, result = 1, values
    while have * 2 <= width:
        result = pick(result[:-have], result[have:])
        have *= 2
    return pick(result[: len(values) - width + 1], result[width - have :])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``data``) and hashes of the anchors of all texts; texts are never crossed."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) < length:
        return none
    hashes = window_hashes(data, GRAM)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    grams = length - GRAM + 1
    least = _sliding(hashes, grams, np.minimum)
    # Zero where no string starts, so that it is never the most.
    least = np.where(left[: len(least)] >= length, least, np.uint64(0))
    padded = np.concatenate(
        [np.zeros(grams - 1, np.uint64), least, np.zeros(grams - 1, np.uint64)]
    )
    most = _sliding(padded, grams, np.maximum)
    places = np.flatnonzero((hashes == most[: len(hashes)]) & (left[: len(hashes)] >= GRAM))
    return places, hashes[places]


def contexts(
    data: np.ndarray, low: np.ndarray, high: np.ndarray, places: np.ndarray, before: int, after: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes around places (zero outside the text), and how many there are each way."""
    around = places[:, None] + np.arange(-before, after)
    inside = (around >= low[:, None]) & (around < high[:, None])
    held = np.where(inside, data[np.where(inside, around, 0)], 0).astype(np.uint8)
    return held, np.minimum(places - low, before), np.minimum(high - places, after)


def common_prefix(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal leading bytes of the rows, at most ``most``."""
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(first, most)


def prefix_intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every interval of neighbours that share ``depth``, deepest first.

    ``common[i]`` is what rows i and i + 1 share; an interval holds at least two rows.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate(common):
        first = i
        while stack and stack[-1][0] > depth:
            deeper, first = stack.pop()
            yield deeper, first, i
        if not stack or stack[-1][0] < depth:
            stack.append((depth, first))
    while stack:
        deeper, first = stack.pop()
        yield deeper, first, len(common)


class AnchoredSuffixes:
    """Anchors with their contexts, sorted by key and suffix."""

    def __init__(self, keys: np.ndarray, held: np.ndarray, left: np.ndarray, right: np.ndarray,
                 before: int, length: int):
        self.length = length
        after = held.shape[1] - before
        suffixes = np.ascontiguousarray(held[:, before:])
        prefixes = np.ascontiguousarray(held[:, before - 1 :: -1] if before else held[:, :0])
        # A text's end sorts before a zero byte: the true length breaks the tie.
        self.order = np.lexsort((right, suffixes.view(f"S{after}")[:, 0], keys))
        by_left = np.lexsort((left, prefixes.view(f"S{before}")[:, 0], keys))
        self.rank = np.empty(len(keys), np.int64)
        self.rank[by_left] = np.arange(len(keys))
        self.prefixes, self.left = prefixes, left
        ordered, lengths, sorted_keys = suffixes[self.order], right[self.order], keys[self.order]
        self.common = common_prefix(
            ordered[1:], ordered[:-1], np.minimum(lengths[1:], lengths[:-1])
        )
        apart = sorted_keys[1:] != sorted_keys[:-1]
        self.groups = np.concatenate([[0], np.flatnonzero(apart) + 1, [len(keys)]])

    def _intervals(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For each suffix interval: depth, first row, its anchors by the bytes before them,
        and what each two neighbours of these share."""
        sizes = np.diff(self.groups)
        for start, size in zip(self.groups[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            for depth, first, last in prefix_intervals(self.common[start : start + size - 1].tolist()):
                if depth + self.prefixes.shape[1] < self.length:
                    continue
                members = self.order[start + first : start + last + 1]
                members = members[np.argsort(self.rank[members])]
                yield depth, start + first, members, self._shared(members[:-1], members[1:])

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return common_prefix(self.prefixes[a], self.prefixes[b], np.minimum(self.left[a], self.left[b]))

    def _pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes before, bytes from it on, both anchors) of the repeats of keys with two anchors.

        Bytes farther off differ on both sides, so what a pair shares is maximal.
        """
        pairs = self.groups[:-1][np.diff(self.groups) == 2]
        both = np.stack([self.order[pairs], self.order[pairs + 1]], axis=1)
        back, ahead = self._shared(both[:, 0], both[:, 1]), self.common[pairs]
        long = back + ahead >= self.length
        return back[long], ahead[long], both[long]

    def _larger(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Maximal repeats of keys with more anchors: intervals that differ on both sides."""
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.arange(len(self.order))
        for depth, first, members, shared in self._intervals():
            long = shared + depth >= self.length
            if not long.any():
                continue
            # Suffixes that share no more than the depth are in different branches.
            steps = self.common[first : first + len(members) - 1] <= depth
            branch = np.concatenate([[0], np.cumsum(steps)])[place[members] - first]
            changes = np.concatenate([[0], np.cumsum(branch[1:] != branch[:-1])]).tolist()
            edges = np.flatnonzero(np.diff(np.concatenate([[0], long, [0]]))).tolist()
            for low, high in zip(edges[::2], edges[1::2]):
                # In one branch the same repeats go on farther and are met there.
                if changes[low] == changes[high]:
                    continue
                for back, start, stop in prefix_intervals(shared[low:high].tolist()):
                    # The bytes before them differ farther back; the suffixes must too.
                    if changes[low + start] < changes[low + stop]:
                        yield back, depth, members[low + start : low + stop + 1]

    def maximal_repeats(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(bytes before the anchor, bytes from it on, anchors) of each maximal repeat."""
        for back, ahead, both in zip(*self._pairs()):
            yield int(back), int(ahead), both
        yield from self._larger()

    def covered(self) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor, how far the maximal repeats that hold it reach both ways.

        Zeros where there are none. Repeats of one anchor all hold it, so together they
        are one span.
        """
        back, ahead = np.zeros(len(self.rank), np.int64), np.zeros(len(self.rank), np.int64)
        shared, depths, both = self._pairs()
        back[both], ahead[both] = shared[:, None], depths[:, None]
        for shared, depth, members in self._larger():
            back[members] = np.maximum(back[members], shared)
            ahead[members] = np.maximum(ahead[members], depth)
        return back, ahead


WINDOW = np.dtype([("first", "<u8"), ("second", "<u4"), ("row", "<i8"), ("start", "<i4"), ("known", "?")])


def windows(
    data: np.ndarray, low: int, high: int, places: np.ndarray, before: int, length: int, row: int
) -> np.ndarray:
    """Every string of ``length`` bytes of one text that holds one of the anchors, hashed."""
    starts = (places[:, None] - np.arange(before + 1)).ravel()
    starts = np.unique(starts[(starts >= low) & (starts + length <= high)])
    part = data[low:high]
    found = np.zeros(len(starts), WINDOW)
    found["first"] = SpanHash(part)(starts - low, starts - low + length)
    found["second"] = SpanHash(part, 0xC2B2AE3D27D4EB4F)(starts - low, starts - low + length) >> np.uint64(32)
    found["row"], found["start"] = row, starts - low
    return found


def repeated_windows(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows that occur at least twice and aren't known yet, and one of each string."""
    order = np.lexsort((found["second"], found["first"]))
    found = found[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found["first"][1:] != found["first"][:-1]) | (found["second"][1:] != found["second"][:-1])
    number = np.cumsum(fresh) - 1
    many = (np.bincount(number) > 1)[number] if len(found) else fresh
    one = found[fresh].copy()
    one["known"] |= many[fresh]
    return found[many & ~found["known"]], one


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint spans, in order, of the same bytes; touching spans are one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(starts) - 1]])
    return starts[fresh], reach[last]
