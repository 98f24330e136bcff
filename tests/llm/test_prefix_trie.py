import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tributary.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(paths):
    """Nodes of {conv_id: tuple of (role, text)}, by walking every prefix."""
    members, children = defaultdict(list), defaultdict(set)
    for conv_id, path in paths.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv_id)
            if depth:
                children[path[:depth - 1]].add(path[:depth])
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, own in members.items():
        for depth in range(len(prefix) + 1):
            leaves[prefix[:depth]] += prefix not in children
            saved[prefix[:depth]] += (len(own) - 1) * len(prefix[-1][1].encode()) if prefix else 0
    return sorted(
        (min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own), len(children.get(prefix, ())), leaves[prefix],
         saved[prefix], hashlib.sha256(",".join(str(c) for c in sorted(own) if paths[c] == prefix).encode()).hexdigest())
        for prefix, own in members.items())


def plain_rebuilt(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {c: [t[2:] for t in sorted(own, key=lambda t: t[:2])] for c, own in turns.items()}
    rebuilt = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(paths.get(c - c % 5, [])[:h] + own[h:])
    return rebuilt


def nodes_of(df):
    return sorted((tuple(r) for r in df.select(*prefix_trie.NODE).collect()), key=lambda r: (r[0], r[1], r[2] or -1, r[3:]))


def wanted(paths):
    return sorted(plain_trie(paths), key=lambda r: (r[0], r[1], r[2] or -1, r[3:]))


@pytest.mark.parametrize(("seed", "turns_a_shard"), [(1, 10**6), (2, 7), (3, 25)])
def test_trie_equals_all_prefixes(spark, seed, turns_a_shard):
    """Random, shared, empty and repeated paths; small shards put most nodes into the skeleton."""
    draw = random.Random(seed)
    paths = {}
    for conv_id in draw.sample(range(500), 160):
        kind = draw.random()
        length = 0 if kind < 0.05 else 9 if kind < 0.4 else draw.randint(0, 6)
        paths[conv_id] = tuple(("user", "the same é") if kind < 0.4 else (draw.choice("ua"), draw.choice(["", "x", "yy ü"])) for _ in range(length))
    rows = [(c, t, *turn) for c, path in paths.items() for t, turn in enumerate(path)]
    table = prefix_trie.conversation_paths(spark.createDataFrame(rows, SCHEMA))
    turnless = spark.createDataFrame([(c, []) for c, path in paths.items() if not path], table.schema)
    assert nodes_of(prefix_trie.prefix_trie(table.union(turnless), turns_a_shard)) == wanted(paths)


def test_one_path_shared_by_most(spark, monkeypatch):
    """The ids that end in one node cross shards and blocks and are hashed in order."""
    monkeypatch.setattr(prefix_trie, "IDS_A_BLOCK", 10)
    same = (("user", "Hi"), ("assistant", "Hello"))
    paths = {c: same for c in range(1000, 1400)} | {c: same + (("user", str(c)),) for c in range(990, 1000)}
    rows = [(c, t, *turn) for c, path in paths.items() for t, turn in enumerate(path)]
    table = prefix_trie.conversation_paths(spark.createDataFrame(rows, SCHEMA))
    assert nodes_of(prefix_trie.prefix_trie(table, 90)) == wanted(paths)


def test_conversations_with_shared_heads(spark):
    draw = random.Random(4)
    rows = []
    for c in [*range(30), 44, 77, 101, 102, 103, 1000]:
        for t in draw.sample([None, *range(20)], draw.randint(1, 12)):
            rows.append((c, t, draw.choice(["user", None, ""]), draw.choice(["a", "b", None, "long " * 5000])))
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    draw.shuffle(rows)
    clashing = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], f"{SCHEMA}, path int, shard int, base int")
    out = prefix_trie.conversation_trie(clashing)
    assert nodes_of(out) == wanted(plain_rebuilt(rows))
    assert {t for _, t in out.dtypes} == {"bigint", "string"}


def test_ties_and_repeated_rows(spark):
    """Turns of one number have a fixed order, whatever the order of the rows; a repeated row is a turn of its own."""
    rows = [(5, 0, "user", "x"), (5, 0, "user", "y"), (5, 0, "user", "y"), (5, None, "user", "z"), (5, None, "user", "w")]
    results = [nodes_of(prefix_trie.conversation_trie(spark.createDataFrame(order, SCHEMA))) for order in (rows, rows[::-1])]
    assert results[0] == results[1] and len(results[0]) == 6


def test_no_conversations(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0


def test_shared_depths(spark):
    pairs = [([], [], 0), ([1], [], 0), ([1, 2], [1, 2], 2), ([1, 2], [1, 2, 3], 2), ([1, 2, 3], [1, 3, 3], 1), ([1], [2], 0)]
    shape = "array<struct<a: bigint, b: bigint, bytes: bigint>>"
    rows = [([(x, 0, 0) for x in a], [(x, 0, 0) for x in b], n) for a, b, n in pairs]
    frame = spark.createDataFrame(rows, f"one {shape}, other {shape}, n int")
    assert all(r.n == r.found for r in frame.select("n", prefix_trie._shared_depth("one", "other").alias("found")).collect())
