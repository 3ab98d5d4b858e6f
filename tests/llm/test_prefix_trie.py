"""Prefix tries against a plain program, over one range and over many, and on odd conversations."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from presscheck.llm import prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(conversations):
    """All nodes of ``{conv_id: [(id, chars), ...]}``."""
    members = {}
    for key, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(key)
    rows = set()
    for node, keys in members.items():
        below = [other for other in members if other[: len(node)] == node]
        children = [other for other in below if len(other) == len(node) + 1]
        ends = sorted(k for k in keys if len(conversations[k]) == len(node))
        rows.add((
            min(keys), len(node), min(members[node[:-1]]) if node else None, len(keys), len(children),
            sum(not any(len(x) == len(o) + 1 and x[: len(o)] == o for x in members) for o in below),
            sum((len(members[o]) - 1) * o[-1][1] for o in below if o),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return rows


def lists(spark, conversations):
    rows = [(k, [t[0].encode().ljust(16) for t in v], [t[1] for t in v]) for k, v in conversations.items()]
    return spark.createDataFrame(rows, "conv_id long, " + prefix_trie.TURNS).repartition(3)


def made(seed, count):
    generator = random.Random(seed)
    turns = [("a", 3), ("b", 5), ("c", 1)]
    return {key * 37: [generator.choice(turns) for _ in range(generator.choice([0, 1, 2, 3, 4, 6]))] for key in range(count)}


@pytest.mark.parametrize("turns_in_a_range", [150_000, 40, 5])
def test_nodes_equal_a_plain_program(spark, monkeypatch, turns_in_a_range):
    """The same whether a node lies in one range or its members in many."""
    monkeypatch.setattr(prefix_trie, "RANGE_TURNS", turns_in_a_range)
    conversations = made(turns_in_a_range, 150)
    found = prefix_trie.nodes(lists(spark, conversations)).select(*COLUMNS).collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == plain(conversations)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_one_conversation_of_very_many_copies(spark, monkeypatch, limit):
    monkeypatch.setattr(prefix_trie, "RANGE_TURNS", 20)
    monkeypatch.setattr(prefix_trie, "BROADCAST_NODES", limit)
    conversations = {k: [("a", 3), ("b", 5)] for k in range(3000)} | {5000: [("a", 3), ("b", 5), ("c", 1)], 6000: [("a", 3)]}
    found = {tuple(r) for r in prefix_trie.nodes(lists(spark, conversations)).select(*COLUMNS).collect()}
    assert found == plain(conversations)


def test_a_long_conversation(spark):
    conversations = {1: [(str(i), i) for i in range(3000)], 2: [(str(i), i) for i in range(2000)]}
    rows = {r.depth: r for r in prefix_trie.nodes(lists(spark, conversations)).collect()}
    assert len(rows) == 3001 and rows[0].saved_tokens == sum(range(2000)) and rows[2000].n_convs == 2
    assert rows[2000].ends_sha256 == hashlib.sha256(b"2").hexdigest() and rows[0].n_leaves == 1


def test_odd_turns(spark):
    long = "x" * 1_000_000
    rows = [
        (1, 2, "user", "b"), (1, None, "user", "a"), (1, 2, "user", "b"), (None, 1, "user", "a"), (2, 1, None, None), (2, 2, "", ""),
        (3, 1, "ab", "c"), (4, 1, "a", "bc"), (5, 1, "user", long),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"ids": F.lit(1), "path": F.lit("x")})
    found = {r.conv_id: r for r in prefix_trie.turn_lists(frame, "conv_id", "turn", "role", "text").collect()}
    assert sorted(found) == [1, 2, 3, 4, 5] and found[1].chars == [1, 1, 1] and found[5].chars == [1_000_000]
    assert found[2].ids[0] == found[2].ids[1] and found[3].ids != found[4].ids and found[1].ids[0] != found[1].ids[1] == found[1].ids[2]
    assert prefix_trie.nodes(prefix_trie.turn_lists(frame.limit(0), "conv_id", "turn", "role", "text")).isEmpty()


def test_heads(spark):
    conversations = {100: [("a", 1), ("b", 1)], 101: [("x", 1), ("y", 1), ("z", 1)], 202: [("p", 1)], 203: [("p", 1), ("q", 1)]}
    frame = lists(spark, conversations)
    key = F.col("conv_id")
    rebuilt = prefix_trie.with_head(frame, key - key % 100, F.when(key == 101, 3).otherwise(1), 5)
    found = {r.conv_id: [bytes(t).strip().decode() for t in r.ids] for r in rebuilt.collect()}
    # The head may be shorter than asked for, or absent.
    assert found == {100: ["a", "b"], 101: ["a", "b"], 202: [], 203: ["q"]}
