import math
import random

import numpy as np
import pytest

from pitlane.llm import mtree
from pitlane.llm.mtree import Space, pages, search, top_products

SCHEMA = "vec_id long, embedding array<float>, label int, row long, cell int, vector string"


def brute(rows, every=50, best=5):
    sound = []
    for n, (i, vector) in enumerate(rows):
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        sound.append((n, i, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for n, q, a in sound:
        if q is None or q % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(a, b, strict=False)), i is None, i or 0, m, i)
            for m, i, b in sound if m != n)
        out += [(q, k + 1, s[4], -s[0]) for k, s in enumerate(scored[:best])]
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA).repartition(3)


@pytest.fixture
def small(monkeypatch):
    """Trees, pages and blocks so small that every part of the search is used."""
    for name, value in {"TREE": 60, "LEAF": 4, "FAN": 3, "BLOCK": 3}.items():
        monkeypatch.setattr(mtree, name, value)


def rows_with_everything():
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(6)]) for i in range(300)]
    same = [0.5, 0.25, 0.0, -0.5, 0.125, 1.0]
    rows += [(1000 + i, same) for i in range(150)]
    rows += [(None, same), (2000, None), (2050, [None] * 6), (2100, [float("nan")] + [0.0] * 5),
             (2150, [float("inf")] + [0.0] * 5), (2200, [0.0] * 6), (2250, [3.0] * 6),
             (100, rows[100][1]), (100, same), (2300, [])]
    return rows


def test_against_all_pairs(spark, small):
    rows = rows_with_everything()
    found = sorted(map(tuple, top_products(table(spark, rows)).collect()), key=repr)
    assert found == brute(rows)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [0.5, 0.5]), (1, [0.25, 0.5]), (2, [0.5])]
    assert sorted(map(tuple, top_products(table(spark, rows)).collect()), key=repr) == brute(rows)


def test_bounds_spare_distances():
    """Two far clusters: a query near one never computes the products with the other."""
    r = np.random.default_rng(0)
    near, far = r.integers(900, 1100, (400, 8)), r.integers(-1100, -900, (400, 8))
    matrix = np.concatenate([near, far])
    space = Space(8, int((matrix**2).sum(axis=1).max()), True)
    tree = mtree.pd.DataFrame([{
        **p, "router": p["router"].tobytes(), "rows": p["places"].astype(np.int64).tobytes(),
        "ids": [int(x) for x in p["places"]], "vectors": matrix[p["places"]].tobytes(),
        "to_router": p["to_router"].tobytes()} for p in pages(space.lifted(matrix))])
    computed = []
    products = Space.products
    try:
        Space.products = lambda self, a, b: computed.append(len(b)) or products(self, a, b)
        found = search(matrix[:1], np.array([0]), np.array([mtree.NONE]), tree, space, 5)
    finally:
        Space.products = products
    scores = matrix @ matrix[0]
    scores[0] = -(1 << 60)
    assert [-s for s, *_ in found[0]] == sorted(scores, reverse=True)[:5]
    assert sum(computed) <= 400


def test_large_components_stay_exact(spark):
    rows = [(i, [float(10_000 * (1 + i)), 7.0, float(20_000 // (1 + i))]) for i in range(60)]
    assert sorted(map(tuple, top_products(table(spark, rows)).collect()), key=repr) == brute(rows)


def test_blocks_are_of_near_cells_and_full(monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK", 10)
    pivots = np.array([[0.0], [100.0], [1.0], [101.0], [2.0], [50.0]])
    blocks = mtree.query_blocks({0: 4, 1: 5, 2: 3, 3: 5, 4: 3, 5: 35}, pivots)
    assert blocks == {0: (0, 1), 2: (0, 1), 4: (0, 1), 5: (1, 4), 1: (5, 1), 3: (5, 1)}
    assert mtree.query_blocks({}, pivots) == {}


def test_pages_do_not_grow_with_blocks_that_do_not_ask(spark, small, monkeypatch):
    """Far clusters: each tree meets the blocks of its own cluster, however many there are."""
    r = np.random.default_rng(1)
    rows = [(c * 1000 + i, [float(x) for x in r.normal(0, 0.01, 4) + 3 * np.eye(4)[c]])
            for c in range(4) for i in range(300)]
    met, plain = [], mtree.pages_asked_for

    def counted(index, wanted):
        met.append((index.count(), plain(index, wanted).count(),
                    wanted.select("block").distinct().count()))
        return plain(index, wanted)

    monkeypatch.setattr(mtree, "pages_asked_for", counted)
    found = sorted(map(tuple, top_products(table(spark, rows)).collect()), key=repr)
    assert found == brute(rows)
    pages_of_all, met_first, blocks = met[0]
    assert blocks >= 4 and met_first <= 2.5 * pages_of_all
    assert met[1][1] <= pages_of_all * blocks / 2


@pytest.mark.parametrize("large", [[1e20, 1.0], [3e37, 1.0], [-9e6, 9e6]])
def test_vectors_beyond_a_long_are_refused(spark, large):
    rows = [(0, [1.0, 2.0]), (50, large), (2, [3.0, 1.0])]
    with pytest.raises(ValueError, match="vec_id 50"):
        top_products(table(spark, rows))


def test_products_up_to_a_long(spark):
    rows = [(0, [8e6, -8e6]), (1, [-8e6, 8e6]), (50, [8e6, 8e6]), (2, [8e6, -8e6]), (3, [0.0, 1.0])]
    assert sorted(map(tuple, top_products(table(spark, rows)).collect()), key=repr) == brute(rows)


def test_empty(spark):
    assert top_products(table(spark, [])).collect() == []
