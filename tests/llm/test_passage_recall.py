from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from matchstats.llm.decontamination import index_items, passages


def shingles(words):
    return Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute_best(item, text):
    """Greatest weighted similarity of the item to any run of the text's words."""
    own, best = shingles(item), 0.0
    for first in range(len(text)):
        there = Counter()
        for end in range(first + 5, min(len(text), first + len(item) * 4 // 3 + 5) + 1):
            there[tuple(text[end - 5 : end])] += 1
            least = sum((own & there).values())
            best = max(best, least / (own.total() + there.total() - least))
    return best


def edits(item, draw):
    """The item cut at either end or both, and with words left out, put in or changed."""
    for cut in range(0, len(item) // 5 + 2):
        yield item[cut:]
        yield item[: len(item) - cut]
        yield item[cut // 2 : len(item) - (cut + 1) // 2]
    for count in (1, 2):
        for at in draw.sample(range(len(item)), 4):
            yield item[:at] + item[at + count :]
            yield item[:at] + [f"put{k}" for k in range(count)] + item[at:]
            yield item[:at] + [f"other{k}" for k in range(count)] + item[at + count :]


@pytest.mark.parametrize("size", [6, 15, 30, 60])
def test_every_passage_that_brute_force_finds(words, size):
    draw = random.Random(size)
    items = [words(size, 700 + k).split() for k in range(3)]
    # One item that repeats its own words.
    items.append(items[0][: size // 2] * 2)
    index = index_items([(k, " ".join(item)) for k, item in enumerate(items)])
    least = 0
    for item, own in enumerate(items):
        texts = [
            [*words(draw.randint(0, 20), k).split(), *passage, *words(9, k + 1).split()]
            for k, passage in enumerate(edits(own, draw))
        ]
        raw = [" ".join(t).encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        found = {t: s for t, i, s, _, _ in passages(index, data, offsets) if i == item}
        want = {t: best for t, text in enumerate(texts) if (best := brute_best(own, text)) >= 0.8}
        assert found == pytest.approx(want)
        least += len(want)
    assert least > 12
