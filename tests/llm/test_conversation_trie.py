from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from matchstats.llm.conversation_trie import prefix_trie, with_shared_heads
from matchstats.llm.joins import looked_up
from matchstats.llm.tree_contraction import subtree_sums

SCHEMA = "conv_id long, turn long, role string, text string, depth string, id long"


def conversations(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in found.items()}


def brute(talks):
    members = defaultdict(list)
    for conv, turns in talks.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children = {n: [m for m in members if len(m) == len(n) + 1 and m[: len(n)] == n] for n in members}
    rows = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(convs) if len(talks[c]) == len(node))
        rows.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            sum(not children[m] for m in below), sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def rebuilt(talks, block=100):
    result = {}
    for conv, turns in talks.items():
        h = zlib.crc32(str(conv).encode()) % 6
        result[conv] = talks.get(conv - conv % block, [])[:h] + turns[h:]
    return result


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def found(trie):
    return sorted(map(tuple, trie.collect()), key=str)


def made(seed):
    draw = random.Random(seed)
    rows = [
        (conv, turn if draw.random() < 0.9 else None, draw.choice(["user", "bot", None]), draw.choice(["a", "bb", "ééé", None, ""]))
        for conv in draw.sample(range(350), 60) for turn in range(draw.randint(1, 7))
    ]
    return rows + draw.sample(rows, 10) + [(None, 1, "user", "nobody's")]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = made(seed)
    assert found(prefix_trie(frame(spark, rows))) == brute(conversations(rows))


def test_rebuilt_conversations(spark):
    rows = made(5)
    talks = rebuilt(conversations(rows))
    assert any(not turns for turns in talks.values())
    mine = frame(spark, rows)
    assert found(prefix_trie(with_shared_heads(mine), mine.select("conv_id"))) == brute(talks)


def test_empty_tables_and_turnless_members(spark):
    none = frame(spark, [(None, 1, "user", "a")])
    assert found(prefix_trie(none)) == []
    assert found(prefix_trie(with_shared_heads(none), none.select("conv_id"))) == []
    members = spark.createDataFrame([(4,), (9,), (None,), (4,)], "conv_id long")
    ends = hashlib.sha256(b"4,9").hexdigest()
    assert found(prefix_trie(none, members)) == [(4, 0, None, 2, 0, 1, 0, ends)]


def test_an_opening_that_nearly_all_share(spark):
    """More members than one piece of their list holds, all ending at one node."""
    same = spark.range(9000).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("hi").alias("text"))
    other = spark.range(9000, 9050).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    rows = {r.depth: r for r in prefix_trie(same.union(other)).where("conv_id = 0").collect()}
    assert rows[0].n_children == 51 and rows[0].n_leaves == 51 and rows[0].saved_tokens == 8999 * 2
    assert rows[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(9000))).encode()).hexdigest()


def test_a_long_conversation(spark):
    rows = [(1, k, "user", f"{k}") for k in range(150)] + [(2, k, "user", f"{k}") for k in range(100)]
    trie = {r.depth: r for r in prefix_trie(frame(spark, rows)).collect()}
    assert len(trie) == 151 and all(r.n_leaves == 1 for r in trie.values())
    assert trie[1].saved_tokens == sum(len(str(k)) for k in range(100)) and trie[101].saved_tokens == 0


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest", "comb"])
def test_contraction_equals_plain_sums(spark, shape):
    draw = random.Random(shape)
    count = 120
    parents = {
        "chain": [k - 1 for k in range(count)], "star": [-1, *[0] * (count - 1)],
        "random": [-1, *(draw.randrange(k) for k in range(1, count))],
        "forest": [draw.randrange(k) if k and draw.random() < 0.8 else -1 for k in range(count)],
        "comb": [-1, *(k - 2 if k % 2 and k > 1 else k - 1 for k in range(1, count))],
    }[shape]
    weights = [draw.randrange(100) for _ in range(count)]
    nodes = spark.createDataFrame(
        [(k, None if p < 0 else p, w, 1) for k, (p, w) in enumerate(zip(parents, weights))], "id long, parent long, w long, one long"
    )
    sums, sizes = list(weights), [1] * count
    for k in range(count - 1, -1, -1):
        if parents[k] >= 0:
            sums[parents[k]] += sums[k]
            sizes[parents[k]] += sizes[k]
    rows = subtree_sums(nodes, ["w", "one"]).collect()
    assert sorted(map(tuple, rows)) == [(k, sums[k], sizes[k]) for k in range(count)]


def test_lookup_of_heavy_keys(spark):
    rows = spark.createDataFrame([(1 if k % 3 else k, k) for k in range(300)] + [(None, 7)], "key long, n long")
    table = spark.createDataFrame([(k, f"v{k}") for k in range(0, 290)], "key long, value string")
    met = looked_up(rows, table, ["key"], share=10)
    assert sorted((r.n, r.value or "") for r in met.collect()) == sorted(
        [(k, f"v{1 if k % 3 else k}" if (k % 3 or k < 290) else "") for k in range(300)] + [(7, "")]
    )
