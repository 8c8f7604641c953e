"""The trie of conversation prefixes against a dictionary of tuples."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from stayscope.llm import prefixtrie, spread
from stayscope.llm.prefixtrie import Parentheses, prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int"


def plain_trie(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, code), (role, text)))
    own = {c: [turn for _, turn in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, own in members.items():
        worth = (len(own) - 1) * len(WORD.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += worth
    out = []
    for k, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(paths[c]) == len(k))
        out.append((min(own), len(k), min(members[k[:-1]]) if k else None, len(own), children[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in prefix_trie(frame).collect()), key=repr)


def random_rows(seed, convs, longest):
    random.seed(seed)
    rows = []
    for c in convs:
        for turn in range(random.randrange(1, longest)):
            rows.append((c, turn, random.choice(["user", "bot"]), random.choice(["a b", "a", "c d  e"])))
    return rows


@pytest.fixture
def small(monkeypatch):
    """Shards, chunks and blocks of a few nodes each."""
    for name, size in {"SHARD": 5, "CHUNK": 2, "BLOCK": 4, "ENDS": 2}.items():
        monkeypatch.setattr(prefixtrie, name, size)


def test_random_tries_in_small_shards_over_many_partitions(spark, small):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = random_rows(1, range(-25, 60), 9)
        assert found(spark, rows) == plain_trie(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(spark, small):
    rows = [
        (0, None, None, None), (0, None, "user", ""), (0, 1, "user", "x  y"), (0, 1, "user", "x  y"), (0, 2, "bot", "z" * 200_000),
        (3, 0, "user", None), (7, None, None, "only"), (40, 5, "a", "b"), (41, 5, "ab", ""), (43, 0, "", "ab"), (None, 1, "user", "lost"), (None, None, None, None),
        (-7, 1, "user", "below zero"), (9, 0, "x", "y"), (9, 0, "y", "x"), (12, 0, "t", "t t"), (12, 0, "t", "t t"), (12, 0, "t", "t t"), (12, 0, "t", "t t"),
    ]
    got = found(spark, rows)
    assert got == plain_trie(rows)
    assert any(len(r) and r[1] == 0 for r in got)


def test_one_conversation_with_most_turns_and_one_opening_of_most_conversations(spark, small):
    rows = [(1_000_001, t, "user", f"turn {t % 3}") for t in range(300)]
    rows += [(c, t, "user", "hello there" if t == 0 else f"{c % 5} {t}") for c in range(20, 120) for t in range(3)]
    rows += [(1_000_001 + 20 * k, t, "user", f"turn {t % 3}") for k in range(1, 4) for t in range(40 * k)]
    assert found(spark, rows) == plain_trie(rows)


def test_whole_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in prefix_trie(frame).collect()), key=repr) == plain_trie(rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie(frame).collect() == []


@pytest.mark.parametrize("block", [2, 8, 64])
def test_closes_are_found_over_blocks(monkeypatch, block):
    monkeypatch.setattr(prefixtrie, "BLOCK", block)
    random.seed(block)
    for size in (1, 2, 7, 100, 900):
        depth = [3]
        while len(depth) < size:
            depth.append(random.randrange(max(0, depth[-1] - 6), depth[-1] + 2))
        for closes in (False, True):
            vector = Parentheses(np.array(depth), closes)
            stack, wanted = [], {}
            for i, bit in enumerate(vector.bits.tolist()):
                if bit:
                    stack.append(i)
                elif stack:
                    wanted[stack.pop()] = i
            got = vector.findclose(vector.open_at).tolist()
            assert got == [wanted.get(i, -1) for i in vector.open_at.tolist()]


def test_frequent_keys_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(spread, "HOT_KEYS", 3)
    left = spark.createDataFrame([(k, i) for k, n in (("a", 50), ("b", 5), ("c", 1)) for i in range(n)], "k string, i int")
    right = spark.createDataFrame([("a", 50, 1), ("b", 5, 2), ("c", 1, 3)], "k string, n long, v int")
    joined = spread.spread_join(left, right, "k", "n")
    assert joined.count() == 56 and joined.select("k", "v").distinct().count() == 3
