from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st

from matchstats.llm.components import connected_components
from matchstats.llm.simhash import fingerprints, linked, near_duplicates, one_of_each, simhash_digest

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute_print(text):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    shingles = [b" ".join(found[k : k + 4]) for k in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) > 0)


def brute_components(prints, radius=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@given(st.lists(st.text(alphabet="aB é\t\n\x0b .", max_size=40), max_size=6))
def test_fingerprints(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    found = fingerprints(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert found.tolist() == [brute_print(t) for t in texts]


@pytest.mark.parametrize("halves", [False, True])
def test_tiles_lose_no_link(halves):
    draw = np.random.default_rng(1)
    base = draw.integers(0, 2**63, 60, dtype=np.uint64)
    near = [int(b) for b in base]
    for _ in range(400):
        value = near[int(draw.integers(len(near)))]
        for bit in draw.integers(0, 64, int(draw.integers(1, 9))):
            value ^= 1 << int(bit)
        near.append(value)
    prints = np.array(sorted(set(near)), np.uint64)
    if halves:
        left, right = prints[::2], prints[1::2]
        parent = linked(left, right, 4)
        both = np.concatenate([left, right]).tolist()
        for i in range(len(left)):
            for j in range(len(right)):
                if (both[i] ^ both[len(left) + j]).bit_count() <= 4:
                    assert parent[i] == parent[len(left) + j]
    else:
        assert linked(prints, None, 4).tolist() == brute_components(prints.tolist())


@pytest.mark.parametrize("tile", [8, 1 << 15])
def test_components_of_documents(spark, documents, words, tile):
    texts = [words(120, seed) for seed in range(12)]
    near = [" ".join(t.split()[:-1]) for t in texts[:5]]
    rows = [(i * 7 % 40 + 100, t) for i, t in enumerate(texts + near + texts[:3])]
    rows += [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A\tb"), (105, texts[0]), (None, texts[11])]
    found = simhash_digest(near_duplicates(documents(rows), tile=tile)).collect()
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints)
    least = {r: min((i for (i, _), q in zip(rows, roots) if q == r and i is not None), default=None) for r in roots}
    want = sorted(((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, roots)), key=repr)
    assert sorted((tuple(r) for r in found), key=repr) == want


def test_one_of_each_stays(spark, documents, words):
    text, other = words(90, 1), words(90, 2)
    rows = [(3, text, 1), (2, text, 2), (2, text, 2), (9, other, 3), (None, other, 4), (None, words(90, 3), 5)]
    frame = documents(rows, "doc_id long, text string, _mark int")
    kept = one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r._mark for r in kept.collect()) == [2, 3, 5]
    assert one_of_each(documents([], "doc_id long, text string, _mark int")).count() == 0


def test_long_chains_have_one_root(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (100, 102), (-5, 200), (7, 7)]
    found = dict(connected_components(spark.createDataFrame(chain, "src long, dst long")).collect())
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100, -5: -5, 200: -5}
