from __future__ import annotations

from hashlib import sha256

import numpy as np
import pytest

from matchstats.llm.sketches import (
    FRACTION,
    from_text,
    likeness,
    merged,
    next_document_likeness,
    sketch_documents,
    to_text,
)
from matchstats.llm.textbytes import SpanHash, window_hashes


def prints(documents, texts):
    found = sketch_documents(documents(list(enumerate(texts)))).collect()
    return [r.fingerprint for r in sorted(found, key=lambda r: r.doc_id)]


def brute(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    hashes = {int(window_hashes(raw[k : k + 16], 16)[0]) >> 24 for k in range(len(raw) - 15)}
    if 0 < len(raw) < 16:
        hashes = {int(SpanHash(raw)(np.array([0]), np.array([len(raw)]))[0]) >> 24}
    return sorted(h for h in hashes if h < (1 << 40) // FRACTION) or sorted(hashes)[:1]


def brute_likeness(a, b):
    left, right = set(brute(a)), set(brute(b))
    return len(left & right) / min(len(left), len(right)) if left and right else float(left == right)


def test_sketches_hold_all_hashes_below_the_fraction(documents, words):
    texts = [words(300, 1), "", None, words(300, 1), words(40, 2), "é" * 50, "short", "other"]
    # Lengths around any at which a text might be treated otherwise.
    texts += [words(200, 9)[:n] for n in (1, 15, 16, 17, 24, 40, 271, 272, 273)] + ["0123456789abcdef" * 200_000]
    found = prints(documents, texts)
    for text, fingerprint in zip(texts[3:], found[3:]):
        fraction, values = from_text(fingerprint)
        assert fraction == FRACTION and values.tolist() == brute(text[:4000] if len(text) > 10**6 else text)
    assert found[0] == found[3] and found[1] == found[2] == f"{FRACTION}:" and found[6] != found[7]
    assert likeness(*map(from_text, found[6:8])) == 0 and likeness(*map(from_text, found[1:3])) == 1


def test_merged_sketches_are_those_of_the_union(documents, words):
    for a, b in [("short", "other"), (words(3, 1)[:18], words(90, 2)), ("", words(90, 3)), (words(70, 4), words(90, 5))]:
        both = merged(*map(from_text, prints(documents, [a, b])))
        hashes = sorted({*brute(a), *brute(b)})
        assert both[1].tolist() == ([h for h in hashes if h < (1 << 40) // FRACTION] or hashes[:1])


def test_names_that_are_taken(documents, words):
    frame = documents([(1, words(50, 1))]).selectExpr("*", "7 AS fingerprint")
    row = sketch_documents(frame).first()
    assert row.fingerprint == 7 and row.fingerprint_.startswith(f"{FRACTION}:")


def test_containment_of_unequal_documents(documents, words):
    long, part = words(6000, 1), words(900, 2)
    whole, small, other = map(from_text, prints(documents, [f"{long} {part}", part, words(900, 3)]))
    assert likeness(whole, small) > 0.95 and likeness(whole, other) < 0.05
    assert likeness(merged(small, other), whole) == pytest.approx(0.5, abs=0.15)
    assert to_text(from_text(to_text(small))) == to_text(small)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_next_document(spark, documents, words, partitions):
    rows = [(i * 5 % 17, words(5 + 20 * i, i)) for i in range(17)]
    rows += [(20, "é😀x"), (21, None), (22, ""), (None, "no id"), (20, "é😀x")]  # one tie, of equals
    frame = documents(rows).selectExpr("*", "1 AS fingerprint", "2 AS place")
    found = next_document_likeness(frame, partitions=partitions).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = {}
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        near = brute_likeness(text, edited), brute_likeness(text, following)
        want.setdefault(i, []).append((len(text), sha256(edited.encode()).hexdigest(), *near))
    got = {}
    for row in found:
        got.setdefault(row.doc_id, []).append((row.n_chars, row.edited_sha256, row.near_edited, row.near_next))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_next_of_one_and_of_none(spark, documents):
    one = next_document_likeness(documents([(1, "abcd")])).first()
    assert (one.edited_sha256, one.near_next) == (sha256(b"abab").hexdigest(), 1.0)
    assert next_document_likeness(documents([])).count() == 0


def test_texts_are_shuffled_once(spark, documents, words):
    frame = next_document_likeness(documents([(i, words(9, i)) for i in range(9)]))
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("REPARTITION_BY_NUM") - plan.count("ReusedExchange") == 1


def test_window_and_span_hashes_tell_strings_apart():
    data = np.frombuffer(b"abcabcabd\0\0a", np.uint8)
    for size in (1, 2, 3, 5):
        strings = [data[k : k + size].tobytes() for k in range(len(data) - size + 1)]
        for hashes in (
            window_hashes(data, size),
            SpanHash(data)(np.arange(len(strings)), np.arange(len(strings)) + size),
        ):
            assert [strings.index(s) for s in strings] == [hashes.tolist().index(h) for h in hashes.tolist()]
