from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from matchstats.llm.repeats import maximal_repeats, repeats_digest, without_repeats
from matchstats.llm.suffix_scan import GRAM, AnchoredSuffixes, contexts, prefix_intervals
from tests.llm.conftest import rows_of

LENGTH = 200


def brute(rows):
    raw = [(text or "").encode() for _, text in rows]
    counts = Counter(b[k : k + LENGTH] for b in raw for k in range(len(b) - LENGTH + 1))
    found = []
    for (doc_id, _), b in zip(rows, raw):
        edges = np.zeros(len(b) + 1, int)
        for k in range(len(b) - LENGTH + 1):
            if counts[b[k : k + LENGTH]] > 1:
                edges[k] += 1
                edges[k + LENGTH] -= 1
        covered = np.cumsum(edges)[: len(b)] > 0
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~covered].tobytes()
        found.append((doc_id, len(b), int(covered.sum()), runs, sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def fixture():
    draw = random.Random(5)

    def text(size, alphabet="abcdefgh é\n"):
        return "".join(draw.choice(alphabet) for _ in range(size))

    part, long = text(150), text(260)
    rows = [
        (1, None), (2, ""), (3, text(199)), (4, "a" * 1000), (5, "a" * 250), (6, long), (7, long),
        (7, long), (None, long + "x"), (8, text(300) + long + text(300)), (9, part * 3),
        (10, text(90) + part + text(90)), (11, "ab" * 700), (12, "\0" * 300 + "x"), (13, "\0" * 210),
        (14, "line of text\n" * 60), (15, text(500) + "line of text\n" * 20 + long[:205]),
    ]
    base = text(1500)
    for i in range(40):
        edited = list(base)
        for _ in range(draw.randint(0, 4)):
            edited[draw.randrange(len(edited))] = draw.choice("xyz")
        rows.append((100 + i, "".join(edited)))
    for i in range(30):
        rows.append((300 + i, text(draw.randint(0, 300)) + long[draw.randint(0, 40) :] + text(draw.randint(0, 200))))
    return rows


@pytest.mark.parametrize("most", [8192, 2], ids=["sorted", "hot"])
def test_removed_bytes(spark, documents, most):
    rows = fixture()
    frame = documents(rows).selectExpr("*", "1 AS row", "2 AS spans", "3 AS key")
    assert rows_of(repeats_digest(without_repeats(frame, most=most))) == brute(rows)


def test_nothing_to_remove(spark, documents):
    assert without_repeats(documents([])).count() == 0
    assert rows_of(repeats_digest(without_repeats(documents([(1, None)])))) == brute([(1, None)])


def test_spans_and_kept_bytes(spark, documents):
    long = fixture()[5][1]
    rows = {r.doc_id: r for r in without_repeats(documents([(1, "x" + long), (2, long + "éy")])).collect()}
    size = len(long.encode())
    assert [tuple(s) for s in rows[1].spans] == [(1, 1 + size)] and bytes(rows[1].kept) == b"x"
    assert bytes(rows[2].kept).decode() == "éy"


def test_maximal_repeats_have_all_occurrences(spark, documents):
    long = fixture()[5][1].encode().decode("ascii", "ignore").replace("\n", " ")[:240]
    rows = [(1, "x" * 3 + long + "y"), (2, "z" + long + "w"), (3, "q" * 9 + long[:225] + "m")]
    groups: dict[tuple, set] = {}
    for repeat, size, doc_id, first in maximal_repeats(documents(rows)).collect():
        groups.setdefault((repeat, size), set()).add((doc_id, first))
    sizes = {size: places for (_, size), places in groups.items()}
    assert sizes[len(long)] == {(1, 3), (2, 1)}
    assert sizes[225] == {(1, 3), (2, 1), (3, 9)}


@pytest.mark.parametrize("edits", [0, 1, 3, 30])
def test_maximal_groups_against_brute_force(edits):
    """Every group that can be extended neither way, with all its anchors; spans come from them."""
    draw, length, gram = random.Random(edits), 60, "g" * GRAM
    before = length - GRAM
    texts, keys = [], []
    for key in range(3):
        head, tail = ("".join(draw.choices("ab", k=40)) for _ in range(2))
        for _ in range(2 if key == 0 else 25):
            edited = list(head + tail)
            for _ in range(draw.randint(0, edits)):
                edited[draw.randrange(80)] = draw.choice("abc")
            around = "".join(edited)
            texts.append((around[draw.choice([0, 0, 5, 35]) : 40], around[40 : draw.choice([80, 80, 61, 45])]))
            keys.append(key)
    raw = [(a + gram + b).encode() for a, b in texts]
    ends = np.cumsum([len(r) for r in raw])
    low = ends - [len(r) for r in raw]
    data = np.frombuffer(b"".join(raw), np.uint8)
    held, left, right = contexts(data, low, ends, low + [len(a) for a, _ in texts], before, length)
    suffixes = AnchoredSuffixes(np.array(keys), held, left, right, before, length)

    def shared(i, j):
        if keys[i] != keys[j]:
            return -1, -1
        back = ahead = 0
        (a, b), (c, d) = ((x[::-1][:before], (gram + y)[:length]) for x, y in (texts[i], texts[j]))
        while back < min(len(a), len(c)) and a[back] == c[back]:
            back += 1
        while ahead < min(len(b), len(d)) and b[ahead] == d[ahead]:
            ahead += 1
        return back, ahead

    want = set()
    for i in range(len(texts)):
        for j in range(i):
            back, ahead = shared(i, j)
            if back + ahead >= length:
                alike = [k for k in range(len(texts)) if k == i or min(np.subtract(shared(i, k), (back, ahead))) >= 0]
                want.add((back, ahead, tuple(alike)))
    groups = [(b, a, tuple(sorted(m.tolist()))) for b, a, m in suffixes.maximal_repeats()]
    assert len(groups) == len(set(groups)) and set(groups) == want and want
    back, ahead = suffixes.covered()
    for k in range(len(texts)):
        reach = [(b, a) for b, a, members in want if k in members] or [(0, 0)]
        assert (back[k], ahead[k]) == tuple(np.max(reach, axis=0))


def test_intervals_of_a_suffix_array():
    text = b"abracadabra"
    order = sorted(range(len(text)), key=lambda i: text[i:])
    common = []
    for a, b in zip(order, order[1:]):
        n = 0
        while text[a + n : a + n + 1] == text[b + n : b + n + 1] != b"":
            n += 1
        common.append(n)
    found = {text[order[low] : order[low] + d]: high - low + 1 for d, low, high in prefix_intervals(common) if d}
    assert found == {b"a": 5, b"abra": 2, b"bra": 2, b"ra": 2}
