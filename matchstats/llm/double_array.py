"""Double-array tries over byte strings, walked by numpy from many places at once.

A state is a cell. From state s the byte b leads to cell base[s] + b, if check there
names s. Cell 0 is the root. ``ends`` are the states that end a key, ascending, and
``numbers`` their keys' numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Nodes that look for their cells together.
_AT_ONCE = 1 << 14


@dataclass(frozen=True)
class DoubleArray:
    base: np.ndarray
    check: np.ndarray
    ends: np.ndarray
    numbers: np.ndarray

    def accepted(self, states: np.ndarray) -> np.ndarray:
        """The numbers of the keys that end in these states; others end none."""
        return self.accepting(states)[1]

    def accepting(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the states end a key, and the numbers of the keys they end."""
        if not len(self.ends):
            return np.zeros(len(states), bool), self.numbers
        at = np.minimum(np.searchsorted(self.ends, states), len(self.ends) - 1)
        ending = self.ends[at] == states
        return ending, self.numbers[at[ending]]

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states and whether each exists."""
        after = self.base[states] + symbols
        return after, self.check[after] == states

    def walk(self, key: bytes) -> int:
        """The state behind the key, -1 if there is none."""
        state = 0
        for symbol in key:
            after = int(self.base[state]) + symbol
            if self.check[after] != state:
                return -1
            state = after
        return state


def _tree(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent and last byte of each node below the root, by level, and each key's node.

    Keys are sorted and distinct, so the keys below a node are neighbours and a node
    begins where its byte or its parent's node changes.
    """
    lengths = np.fromiter(map(len, keys), np.int64, len(keys))
    data = np.frombuffer(b"".join(keys), np.uint8)
    starts = np.cumsum(lengths) - lengths
    ends = np.zeros(len(keys), np.int64)
    parents, symbols, made = [], [], 1
    rows, at = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    level = 0
    while True:
        going = lengths[rows] > level
        ends[rows[~going]] = at[~going]
        rows, at = rows[going], at[going]
        if not len(rows):
            break
        symbol = data[starts[rows] + level]
        new = np.ones(len(rows), bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (at[1:] != at[:-1])
        parents.append(at[new])
        symbols.append(symbol[new])
        at = made + np.cumsum(new) - 1
        made += int(new.sum())
        level += 1
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *parents]), np.concatenate([empty, *symbols]).astype(np.int64), ends


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places starts[k] to starts[k] + lengths[k] of all k, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def build(keys: list[bytes], seed: int = 0) -> DoubleArray:
    """The trie of sorted distinct keys; a key's number is its place in the list.

    Nodes with several children are placed first, the widest first, in rounds: all that
    are left propose a base each, at drawn free cells of the part in use and a little
    beyond, and those whose children's cells are free and claimed by no other stay. A
    single child goes to any free cell.
    """
    parents, symbols, ends = _tree(keys)
    count = len(parents) + 1
    draw = np.random.default_rng(seed)
    # Children of one node follow each other: a level lists them by parent.
    order = np.argsort(parents, kind="stable")
    of = parents[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(parents) else order
    width = np.diff(np.r_[first, len(parents)])
    used = np.zeros(4 * count + 4096, bool)
    used[:256] = True
    cell, base = np.zeros(count, np.int64), np.zeros(count, np.int64)
    claims = np.zeros(len(used), np.int64)
    top = 512
    wide = np.flatnonzero(width > 1)
    wide = wide[np.argsort(-width[wide], kind="stable")]
    for at in range(0, len(wide), _AT_ONCE):
        left = wide[at : at + _AT_ONCE]
        while len(left):
            free = np.flatnonzero(~used[256:top]) + 256
            if len(free) < 2 * len(left) or len(left) > 0.8 * _AT_ONCE:
                top += int(width[left].sum()) + 256
            else:
                top += 256 + top // 64
            if top + 512 > len(used):
                used = np.concatenate([used, np.zeros(top + 512, bool)])
                claims = np.zeros(len(used), np.int64)
            free = np.flatnonzero(~used[256:top]) + 256
            anchors = draw.choice(free, min(len(free), len(left)), replace=False)
            tried = left[: len(anchors)]
            kids = order[_spans(first[tried], width[tried])]
            owner = np.repeat(np.arange(len(tried)), width[tried])
            start = anchors - symbols[order[first[tried]]]
            cells = start[owner] + symbols[kids]
            claims[cells] = owner
            fits = np.bincount(owner, (claims[cells] != owner) | used[cells], len(tried)) == 0
            fits &= start >= 0
            stays = fits[owner]
            used[cells[stays]] = True
            cell[kids[stays] + 1] = cells[stays]
            base[of[first[tried[fits]]]] = start[fits]
            left = np.concatenate([tried[~fits], left[len(anchors):]])
    single = order[first[width == 1]] if len(parents) else order
    free = np.flatnonzero(~used[256:]) + 256
    if len(free) < len(single):
        free = np.concatenate([free, len(used) + np.arange(len(single) - len(free))])
    cell[single + 1] = free[: len(single)]
    base[parents[single]] = cell[single + 1] - symbols[single]
    cells = int(cell.max()) + 257
    result = DoubleArray(np.zeros(cells, np.int32), np.full(cells, -1, np.int32), *_numbered(cell[ends]))
    result.base[cell] = base
    result.check[cell[1:]] = cell[parents]
    return result


def _numbered(states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(states)
    return states[order].astype(np.int32), order.astype(np.int32)


def counted(
    trie: DoubleArray, buffer: np.ndarray, places: np.ndarray, states: np.ndarray,
    closing: int, last: np.ndarray, keys: int, times: np.ndarray | None = None,
) -> np.ndarray:
    """How often each key is read from the given places, each from its own state.

    All places advance together, a byte a level. A key is counted where it ends with the
    byte ``closing``; behind places marked in ``last`` reading stops. A place counts once, or
    as many ``times`` as given.
    """
    accepted, weights = [np.zeros(0, trie.numbers.dtype)], [np.zeros(0, np.int64)]
    times = np.ones(len(places), np.int64) if times is None else times
    while len(places):
        symbols = buffer[places]
        states, exists = trie.step(states, symbols.astype(np.int32))
        places, states, symbols, times = places[exists], states[exists], symbols[exists], times[exists]
        closed = symbols == closing
        if closed.any():
            ending, numbers = trie.accepting(states[closed])
            accepted.append(numbers)
            weights.append(times[closed][ending])
            on = ~(closed & last[places])
            places, states, times = places[on], states[on], times[on]
        places = places + 1
    # Sums of whole numbers are exact up to 2^53.
    return np.bincount(np.concatenate(accepted), np.concatenate(weights), keys).astype(np.int64)
