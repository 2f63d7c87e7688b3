import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartspark.llm.prefix_trie import prefix_trie, turn_digests
from cartspark.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def plain(conversations):
    """conversations: {conv_id: [(role, text)]}. Rows of the trie as a set of tuples."""
    members, below, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    for path in members:
        for d in range(len(path) + 1):
            below[path[:d]].add(path)
    children = {p: sum(len(q) == len(p) + 1 for q in below[p]) for p in members}
    out = set()
    for path, of in members.items():
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below[path] if q)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        leaves = sum(children[q] == 0 for q in below[path])
        out.add((min(of), len(path), parent, len(of), children[path], leaves, saved, digest))
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def table(spark, conversations):
    rows = [(c, i, r, t, "mine") for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    random.Random(0).shuffle(rows)
    return turn_digests(spark.createDataFrame(rows, SCHEMA)), spark.createDataFrame([(c,) for c in conversations], "conv_id long")


@pytest.mark.parametrize("block_turns", [1, 3, 4])
def test_random_conversations(spark, block_turns):
    rng = random.Random(block_turns)
    made = {}
    for c in rng.sample(range(-50, 500), 150):
        start = list(rng.choice(list(made.values()))) if made and rng.random() < 0.7 else []
        start = start[: rng.randint(0, len(start))]
        made[c] = start + [(rng.choice("ua"), "é" * rng.randint(0, 3)) for _ in range(rng.randint(0, 7))]
    assert rows_of(prefix_trie(*table(spark, made), block_turns)) == plain(made)


def test_paths_that_hang_from_each_other_and_one_hot_conversation(spark):
    line = [("u", str(i)) for i in range(40)]
    # Each conversation leaves the one before a turn later: as deep as a trie can hang.
    made = {i: line[:i] + [("a", f"end {i}")] for i in range(40)}
    made |= {1000 + i: line[:7] for i in range(300)} | {2000: []}
    assert rows_of(prefix_trie(*table(spark, made))) == plain(made)


def test_nulls_ties_repeated_rows_and_empty_table(spark):
    rows = [
        (1, None, None, None, None), (1, 2, "u", "b", None), (1, 2, "u", "b", None), (2, 5, "", "", None), (2, None, "", "", None),
        (None, 1, "u", "b", None), (3, 1, "x", "\n", None), (4, 1, "x\n", "", None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    made = {1: [("", ""), ("u", "b"), ("u", "b")], 2: [("", "")] * 2, 3: [("x", "\n")], 4: [("x\n", "")]}
    assert rows_of(prefix_trie(turn_digests(df))) == plain(made)
    none = turn_digests(df.limit(0))
    assert prefix_trie(none).count() == 0
    silent = spark.createDataFrame([(7,), (9,), (7,), (None,)], "conv_id long")
    assert rows_of(prefix_trie(none, silent)) == plain({7: [], 9: []})


def test_query_equals_plain_version(spark, folder):
    rng = random.Random(4)
    rows = [(c, t, rng.choice("ua"), rng.choice(["", "x", "yé"]), None) for c in range(0, 120, 1) for t in range(rng.randint(1, 9))]
    rows = [r for r in rows if r[0] % 10] + [(None, 1, "u", "q", None)]
    spark.createDataFrame(rows, SCHEMA).withColumn("turn", F.when(F.col("turn") > 0, F.col("turn"))).write.parquet(
        f"{folder}/conversations.parquet"
    )
    turns = defaultdict(list)
    for c, _, role, text, _ in sorted(rows[:-1], key=lambda r: (r[0], r[1])):
        turns[c].append((role, text))
    made = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    assert any(not t for t in made.values())
    assert rows_of(op13_prefix_trie(spark, folder)) == plain(made)
