import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from pitlane.llm.components import components
from pitlane.llm.simhash import (
    fingerprint, fingerprint_links, keep_one_each, near_duplicate_components, near_links,
)
from .support import document_table


def slow(text, shingle=4):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(prints, radius):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= radius:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in prints}


def expected(rows):
    prints = [slow(t) for _, t in rows]
    roots = roots_of(set(prints), 4)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    return Counter((i, f"{p:016x}", least.get(roots[p])) for (i, _), p in zip(rows, prints, strict=True))


def test_fingerprints():
    for text in ["", "a", "A b", "a b c d", "É a B\tc d\n e", "x y z w v", "  a b c d e",
                 "w " * 40_000, "same same same same same same other"]:
        assert fingerprint(text) == slow(text)


def test_every_document(edge):
    rows, docs = edge
    found = Counter(map(tuple, near_duplicate_components(docs, tile=64).collect()))
    assert found == expected(rows)


def test_near_copies_are_linked_over_tiles(spark):
    r = random.Random(2)
    base = [r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(800)]
    rows = []
    for i in range(60):
        words = list(base)
        words[r.randrange(800)] = f"changed{i}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(i, " ".join(r.choice("abcdefgh") * 3 for _ in range(50))) for i in range(30)]
    docs = document_table(spark, rows)
    found = Counter(map(tuple, near_duplicate_components(docs, tile=12).collect()))
    assert found == expected(rows)
    assert max(Counter(c for _, _, c in found).values()) > 10
    kept = {r.doc_id for r in keep_one_each(docs, tile=12).collect()}
    assert kept == {c for _, _, c in expected(rows)}


@pytest.mark.parametrize("radius", [0, 1, 4])
def test_links_of_blocks_by_brute_force(radius):
    r = np.random.default_rng(radius)
    centres = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    noise = np.uint64(1) << r.integers(0, 64, (600, 3)).astype(np.uint64)
    prints = np.unique(r.choice(centres, 600) ^ noise[:, 0] ^ noise[:, 1] ^ noise[:, 2])
    left, right = prints[::2], prints[1::2]
    links = [*near_links(left, None, radius), *near_links(right, None, radius),
             *near_links(left, right, radius)]
    parent = {int(p): int(p) for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert (int(a) ^ int(b)).bit_count() <= radius * 64
        x, y = root(int(a)), root(int(b))
        parent[max(x, y)] = min(x, y)
    exact = roots_of([int(p) for p in prints], radius)
    assert {p: root(p) for p in exact} == exact
    assert len(links) <= 3 * len(prints)


def test_links_do_not_grow_with_the_square_of_a_group(spark):
    """Thousands of fingerprints all near each other give a forest."""
    prints = spark.range(1024).selectExpr(
        "shiftleft(id % 8, 3) + shiftleft(cast(floor(id / 8) % 2 as bigint), 40) as fingerprint"
    ).distinct()
    count = prints.count()
    assert fingerprint_links(prints, tile=8).count() <= 40 * count


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 100)] + [(1000, 1000), (1005, 1000)]
    links = spark.createDataFrame(chain + star, "a long, b long").repartition(4)
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 1000 for i in range(1000, 1100)}
    assert components(links.limit(0)).collect() == []


def test_one_of_each_component_stays_whole(edge):
    rows, docs = edge
    kept = keep_one_each(docs, tile=64)
    assert kept.columns == docs.columns
    prints = {i: slow(t) for i, t in enumerate(t for _, t in rows)}
    roots = roots_of(set(prints.values()), 4)
    firsts = {}
    for n, (i, _) in enumerate(rows):
        root = roots[prints[n]]
        firsts[root] = min(firsts.get(root, (True, 0)), (i is None, i or 0))
    found = sorted(((r.doc_id is None, r.doc_id or 0) for r in kept.collect()))
    assert found == sorted(firsts.values())


def test_empty(empty):
    assert near_duplicate_components(empty).collect() == []
    assert keep_one_each(empty).collect() == []
