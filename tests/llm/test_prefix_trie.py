import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from pitlane.llm.prefix_trie import (
    NODE, TernaryTree, conversation_trie, median_first, rebuilt, sequences, trie)

SCHEMA = "conv_id long, turn long, role string, text string, key binary, n_convs long, ids string"


def brute_force(conversations):
    """{conv_id: [(role, text, words)]} to the rows of NODE."""
    whole = {}
    for c, own in conversations.items():
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = conversations.get(base, [])[:h] + own[h:]
    return nodes_of(whole)


def nodes_of(whole):
    members, ends = {}, {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = Counter(p[:-1] for p in members if p)
    out = Counter()
    for prefix, convs in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        out[(min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs),
             children[prefix], sum(not children[p] for p in below),
             sum((len(members[p]) - 1) * p[-1][2] for p in below if p),
             hashlib.sha256(",".join(map(str, sorted(ends.get(prefix, [])))).encode()).hexdigest())] += 1
    return out


def count_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def as_turns(rows):
    """The conversations of (conv_id, turn, role, text) rows."""
    def order(row):
        _, turn, role, text = row
        body = f"{len(role or '')}:{role or ''}{text or ''}"
        return turn is not None, turn or 0, hashlib.sha256(body.encode()).digest()

    out = {}
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        out.setdefault(row[0], []).append((row[2] or "", row[3] or "", count_words(row[3])))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*row, b"k", 5, "x") for row in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    said = ["hello there", "hello\tthere", "", None, "yes", "no no", "go on\n", "😀 fine"]
    made = []
    for c in [*range(100), *range(-45, -38), 200, 201, 219, 241, 243]:
        for turn in range(r.choice([1, 2, 2, 3, 4, 6, 9])):
            made.append((c, turn, ["user", "assistant"][turn % 2], r.choice(said[:3 + c % 6])))
    made += [(c, t, "user", "the same") for c in range(300, 420) for t in range(3)]  # copies
    made += [(500, t, "user", f"turn {t}") for t in range(300)] + [
        (501, t, "user", f"turn {t}") for t in range(280)]  # long ones
    made += [(None, 0, "user", "nobody"), (600, None, None, None), (600, 2, "user", "a"),
             (600, 2, "user", "b"), (600, 2, "user", "b"), (601, 1, "", "long " * 20_000)]
    return made


def test_nodes(spark, rows):
    found = conversation_trie(table(spark, rows))
    assert found.columns == NODE
    assert Counter(map(tuple, found.collect())) == brute_force(as_turns(rows))


@pytest.mark.parametrize("block, fan, parts", [(1, 2, 7), (3, 64, 3), (40, 3, 11), (10_000, 2, 1)])
def test_blocks_and_rounds_change_nothing(spark, block, fan, parts):
    r = random.Random(block)
    whole = {c: [(t, t % 3) for t in r.choices(range(4), k=r.choice([0, 0, 1, 2, 3, 5, 8]))]
             for c in r.sample(range(1000), 250)}
    whole |= {2000 + c: [(1, 1), (2, 2)] for c in range(150)}
    df = spark.createDataFrame(
        [(c, [t for t, _ in s], [w for _, w in s]) for c, s in whole.items()],
        "conv_id long, ids array<long>, words array<int>").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = Counter(map(tuple, trie(df, block, fan).collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == nodes_of({c: [(t, t, w) for t, w in s] for c, s in whole.items()})


def test_turnless_after_rebuilding(spark):
    # 43 takes 3 turns of 40, which is absent, and has fewer of its own.
    lengths = {c: zlib.crc32(str(c).encode()) % 4 for c in range(41, 60)}
    c = next(c for c, h in lengths.items() if h)
    rows = [(c, 0, "user", "alone")]
    found = rebuilt(sequences(table(spark, rows))).collect()
    assert [(r.conv_id, r.ids, r.words) for r in found] == [(c, [], [])]
    root = conversation_trie(table(spark, rows)).collect()
    assert [tuple(r)[:7] for r in root] == [(c, 0, None, 1, 0, 1, 0)]


def test_empty(spark):
    assert conversation_trie(table(spark, [])).collect() == []


def test_the_search_trees_are_balanced():
    assert sorted(median_first(100)) == list(range(100))
    tree = TernaryTree()
    for n in median_first(1000):
        tree.insert([7, n], [1, 1])

    def height(node):
        return node and 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.equal[tree.equal[0]]) == 10
    assert tree.turn[tree.path([7, 123])[-1]] == 123
