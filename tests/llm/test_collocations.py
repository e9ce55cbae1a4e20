from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from matchstats.llm.collocations import (
    Named, Pieces, _by_tries, _Places, _read, _summed, _told_counts, best_collocations, phrase_counts, score_phrases,
)
from matchstats.llm.double_array import build, counted

SCHEMA = "doc_id long, text string, lang string, n string"


def brute(rows, most=3, least=10):
    """Phrase counts, scores and survivors by plain counting."""
    counts, totals = Counter(), Counter()
    for _, text, lang, _ in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, most + 1):
                for at in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[at : at + size])] += 1
    counts = {k: n for k, n in counts.items() if n >= least}
    scored = {}
    for (lang, words), a in counts.items():
        if len(words) < 2:
            continue
        inside = any(
            of == lang and len(longer) > len(words) and 100 * f >= 50 * a
            and any(longer[k : k + len(words)] == words for k in range(len(longer)))
            for (of, longer), f in counts.items()
        )
        if not inside:
            cuts = [(1000000 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            scored[lang, " ".join(words)] = (a, counts[lang, words[:k]], counts[lang, words[k:]], score)
    return counts, totals, scored


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(2)
    vocabulary = ["New", "YORK", "city", "la", "élan", "vital", "x", "of", "the", "日本", "語"]
    made = []
    for i in range(120):
        words = draw.choices(vocabulary, k=draw.randint(0, 30))
        gaps = draw.choices([" ", " ", " ", "\t", ", ", ".\n", "! ", "\x0b", "  "], k=len(words))
        made.append((i, "".join(w + g for w, g in zip(words, gaps)), draw.choice(["en", "fr", None, "und"]), "x"))
    made += [(None, None, "en", None), (7, "", None, None), (7, "New York", "en", "x"), (7, "New York", "en", "x")]
    made += [(8, "same again " * 40, "hot", None), (9, " \t.,", "none", None)]
    return made


@pytest.mark.parametrize(("buckets", "trie_bytes"), [(1 << 16, 1 << 20), (64, 1 << 20), (1 << 12, 300)])
def test_all_sizes_give_the_same_counts(spark, rows, buckets, trie_bytes):
    """Also where nearly all phrases share a bucket, and where candidates fill many tries."""
    counts, totals, scored = brute(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = phrase_counts(frame, buckets=buckets, trie_bytes=trie_bytes)
    phrases = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found.collect() if r.words}
    assert {r.lang: r.n for r in found.collect() if not r.words} == totals
    assert {k: n for k, n in phrases.items() if len(k[1]) > 1} == {k: n for k, n in counts.items() if len(k[1]) > 1}
    assert phrases.items() <= counts.items()
    best = score_phrases(found)
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.score) for r in best.collect()} == scored


def test_texts_are_read_as_often_whatever_the_number_of_tries(spark, rows):
    """Also where candidates fill hundreds of tries, a text is read for each level, once to count, once for its size."""
    read = {}
    for trie_bytes in (30, 1 << 20):
        texts = spark.sparkContext.accumulator(0)

        def passed(batches, texts=texts):
            for batch in batches:
                texts.add(batch.num_rows)
                yield batch

        frame = spark.createDataFrame(rows, SCHEMA).mapInArrow(passed, SCHEMA)
        found = phrase_counts(frame, trie_bytes=trie_bytes, buckets=1 << 12, least=2)
        read[trie_bytes] = texts.value / len(rows), sorted(map(tuple, found.collect()))
    assert read[30] == read[1 << 20]
    assert read[30][0] <= 5


def test_told_places_are_counted_by_many_tries():
    """Beginnings of told phrases count as often as told, in tries of few bytes too."""
    draw = random.Random(8)
    told = Counter(tuple(draw.choices(["a", "bb", "c", "日"], k=draw.randint(2, 4))) for _ in range(400))
    expected = Counter()
    for phrase, times in told.items():
        for size in range(2, len(phrase) + 1):
            expected[" ".join(phrase[:size])] += 300 * times
    # Told twice, by two tasks.
    blob = "".join(" ".join(phrase) + "\n" for phrase in told).encode()
    counts = [np.array([part * n for n in told.values()], "<u2").tobytes() for part in (100, 200)]
    for least, trie_bytes in ((1, 1 << 20), (1, 20), (3000, 20)):
        places = _Places("en", [(blob, counts[0]), (blob, counts[1])])
        rows = [r for batch in _by_tries("en", places, 2, least, trie_bytes) for r in batch.to_pylist()]
        assert {r["phrase"]: r["n"] for r in rows} == {k: n for k, n in expected.items() if n >= least}
        assert len(rows) == len({r["phrase"] for r in rows}) and {r["lang"] for r in rows} == {"en"}
        assert all(r["words"] == len(r["phrase"].split(" ")) for r in rows)


def test_a_large_slice_is_held_once():
    """What many tasks told of the same two words is put together before it is read."""
    text = " ".join(f"of the x{k}," for k in range(2000)) + " of the x1"
    rows = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    data = np.frombuffer(text.encode(), np.uint8)
    pieces, told = Pieces(rows, data, np.array([0, len(data)])), Named(4)
    of = pieces.grams(3)
    told.add(pieces, 3, of, pieces.hashes(2, of))
    (row,) = told.packed().to_pylist()
    schema = pa.schema([("slice", pa.int64()), ("part", pa.int64()), ("lang", pa.string()), ("places", pa.binary()), ("counts", pa.binary())])
    batch = pa.RecordBatch.from_pylist([{"slice": row["part"], "part": 0, "lang": "en", "places": row["phrases"], "counts": row["counts"]}], schema)
    size, peak = len(row["phrases"]), {}
    for tasks in (20, 400):
        tracemalloc.start()
        found = [r for b in _read((batch for _ in range(tasks)), 4, 10, 1 << 20, 4 * size) for r in b.to_pylist()]
        peak[tasks] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        expected = {f"of the x{k}": tasks * (2 if k == 1 else 1) for k in range(2000)} | {"of the": 2001 * tasks}
        assert {r["phrase"]: r["n"] for r in found} == expected
    assert peak[400] < 3 * peak[20]


def test_counts_past_a_byte(spark, rows):
    """A task may hold more of a bucket than its smallest counters do."""
    many = rows * 40
    counts, _, _ = brute(many, least=300)
    found = phrase_counts(spark.createDataFrame(many, SCHEMA).repartition(3), least=300)
    phrases = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found.where("words > 1").collect()}
    assert phrases == {k: n for k, n in counts.items() if len(k[1]) > 1} and phrases


def test_longer_phrases(spark, rows):
    _, _, scored = brute(rows, most=5, least=3)
    found = score_phrases(phrase_counts(spark.createDataFrame(rows, SCHEMA), most_words=5, least=3, buckets=1 << 14), 5)
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.score) for r in found.collect()} == scored


def test_ranks_and_totals(spark, rows):
    _, totals, scored = brute(rows, least=3)
    found = best_collocations(spark.createDataFrame(rows, SCHEMA), best=4, least=3).collect()
    for lang in {"en", "fr", "und", "hot"}:
        order = sorted((-s, -a, p.encode()) for (of, p), (a, _, _, s) in scored.items() if of == lang)
        mine = sorted((r for r in found if r.lang == lang), key=lambda r: r["rank"])
        assert [(-r.score, -r.a, r.phrase.encode()) for r in mine] == order[:4]
        assert {r.n for r in mine} == {totals[lang]}
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000
    counts = spark.createDataFrame(
        [("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, 3 * big)], "lang string, phrase string, words int, n long"
    )
    assert score_phrases(counts).first().score == 1000000 * big * big // ((big + 1) * 3 * big)


def test_empty_and_long_texts(spark):
    assert best_collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = spark.createDataFrame([(1, None, None, None), (2, "", "en", None)], SCHEMA)
    assert best_collocations(nothing).collect() == []
    long = spark.createDataFrame([(1, "a b " * 2_000_000, "en", None)], SCHEMA)
    found = {r.phrase: r.a for r in best_collocations(long).collect()}
    assert found == {"a b a": 1999999, "b a b": 1999999}


def test_tries_hold_their_keys():
    draw = random.Random(4)
    keys = {bytes(draw.choices(range(256), k=draw.randint(1, 6))) for _ in range(3000)}
    keys |= {bytes([a, b]) for a in range(40) for b in range(256)}
    keys = sorted(keys)
    trie = build(keys)
    for number, key in enumerate(keys):
        assert trie.accepted(np.array([trie.walk(key)])).tolist() == [number]
    held = set(keys)
    for _ in range(2000):
        other = bytes(draw.choices(range(256), k=draw.randint(1, 7)))
        state = trie.walk(other)
        assert bool(state >= 0 and len(trie.accepted(np.array([state])))) == (other in held)
    assert build([]).walk(b"a") == -1
    solo = build([b"solo"])
    assert solo.accepted(np.array([solo.walk(b"solo"), solo.walk(b"sol")])).tolist() == [0]


def test_counting_stops_at_the_end_of_a_piece():
    trie = build(sorted([b"a ", b"a b ", b"b "]))
    buffer = np.frombuffer(b"a b a b ", np.uint8)
    last = np.zeros(8, bool)
    last[[5, 7]] = True
    counts = counted(trie, buffer, np.array([0, 2, 4, 6]), np.zeros(4, np.int32), 0x20, last, 3)
    assert counts.tolist() == [2, 1, 2]


def test_counts_are_told_in_few_rows():
    """A task tells a row for many keys, whatever its counts, and sums come back whole."""
    draw = np.random.default_rng(5)
    many = [draw.integers(0, 3, 100_000), draw.integers(0, 70_000, 100_000), draw.integers(0, 1 << 40, 100_000)]
    told = [_told_counts(counts, 7) for counts in many]
    assert max(batch.num_rows for batch in told) <= 25
    told += [_told_counts(np.array([n]), None, lang) for lang, n in [("en", 5), ("fr", 0), ("en", 1 << 33)]]
    rows = sorted((r for batch in told for r in batch.to_pylist()), key=lambda r: (r["slice"] or -1, r["part"], r["lang"] or ""))
    batches = [pa.RecordBatch.from_pylist(rows[at : at + 10], told[0].schema) for at in range(0, len(rows), 10)]
    found = [r for batch in _summed(iter(batches)) for r in batch.to_pylist()]
    whole = sum(many)
    assert {r["number"]: r["n"] for r in found if r["slice"] == 7} == {k: n for k, n in enumerate(whole.tolist()) if n}
    assert sorted((r["lang"], r["n"]) for r in found if r["slice"] is None) == [("en", 5 + (1 << 33)), ("fr", 0)]
    assert list(_summed(iter([]))) == []


def test_named_phrases_are_packed_in_little_memory():
    """A task packs some 16 MB at once, next to another on its executor."""
    draw = random.Random(6)
    text = " ".join("".join(draw.choices("abcdefgh", k=9)) for _ in range(100_000)).encode()
    rows = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text.decode()]})
    pieces, named = Pieces(rows, np.frombuffer(text, np.uint8), np.array([0, len(text)])), Named()
    for size in (3, 2):
        of = pieces.grams(size)
        hashes = pieces.hashes(size, of)
        named.add(pieces, size, of, hashes)
    size, expected = named.bytes, Counter()
    for words in (3, 2):
        split = text.split(b" ")
        expected.update(b" ".join(split[at : at + words]) for at in range(len(split) - words + 1))
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    packed = named.packed()
    peak = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert peak < 8 * size
    assert Counter(p for r in packed.to_pylist() for p in r["phrases"].split(b"\n")[:-1]) == expected
    assert sorted(r["part"] for r in packed.to_pylist()) == [r["part"] for r in packed.to_pylist()]
