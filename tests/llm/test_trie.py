import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from agoralens.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, ka string, n string"


def brute(rows):
    """Nodes by a dictionary of all prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), key, role, text))
    own = {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in own.items()}
    members, last, ends = defaultdict(set), {}, defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100
        path = own.get(c - base, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
        ends[tuple(path)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in prefix_trie.trie(df, **options).collect())


def some(seed, convs, turns=9):
    draw = random.Random(seed)
    ids = draw.sample(range(-250, 900), convs)
    return [(c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bé", "c" * 50])) for c in ids for t in range(draw.randint(1, turns))]


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rows = some(seed, 300)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    """NULL turns, roles, texts and ids, repeated rows, equal turn numbers and many copies."""
    rows = some(3, 60) + [(1, None, None, None), (1, None, None, None), (1, 0, "", "z"), (1, 0, "user", "y"), (None, 1, "user", "x")]
    rows += [(c, t, "user", f"copy {t}") for c in range(2000, 2120) for t in range(4)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(None, 1, "user", "x")]) == []


def test_empty_table(spark):
    assert found(spark, []) == []


def test_long_conversations(spark, monkeypatch):
    """Conversations of several bands and shards, numbered by key ranges."""
    monkeypatch.setattr(prefix_trie, "BAND", 8)
    rows = [(c, t, "user", f"{t % 5}" if c < 104 or t < 30 else f"{c} {t}") for c in range(100, 108) for t in range(40 + 7 * (c % 3))] + some(4, 40)
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, long=20) == brute(rows)


def test_shards(monkeypatch):
    """Bitsets of several shards give the members of one."""
    shard = prefix_trie.Shard()
    for conv, path in ((1, [(5, 6, 2), (7, 8, 1)]), (2, [(5, 6, 2)]), (3, [])):
        shard.open(conv, True, (0, 0, 0))
        for turn in path:
            shard.add(*turn)
    assert sorted((d, n, conv, ends) for d, _, _, _, _, n, conv, _, ends in shard.nodes()) == [(0, 3, 1, "3"), (1, 2, 1, "2"), (2, 1, 1, "1")]


def test_band_limits_reach_workers(spark):
    """Every shard bound gives the same nodes."""
    rows = some(5, 200)
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(7)
    assert sorted(tuple(r) for r in prefix_trie.trie(df).collect()) == brute(rows)
