"""Exact search for the largest inner products with M-trees.

Inner products become distances by one more component: with M the largest squared norm, a stored
vector x gets sqrt(M - |x|^2) and a query zero, and the nearest stored vector is the one with the
largest product. Vectors are routed to the nearest of a bounded number of pivots; a cell with more
rows than one tree should hold, such as one of very many copies, is dealt out to several trees. A
tree is written as pages: a page has a routing vector, a covering radius, its distance to the routing
vector of the page above, and a leaf the distances of its entries to its routing vector.

A block of queries goes through a tree best first. By the triangle inequality the stored distances
bound the distance to a page or an entry from below, and what lies beyond the worst of a query's best
so far is never computed. Queries search the cell that they lie in first, which bounds what the other
cells can add, then the cells that may still hold something better. Blocks are made of queries that
lie near each other, and a tree meets the blocks that ask for it and no other.
"""

import heapq
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.llm.common import stage

EVERY = 50
BEST = 5
#: Rows of a tree, entries of a leaf, children of an inner page, queries that are searched together.
TREE, LEAF, FAN, BLOCK = 8192, 256, 32, 4096
#: Most pivots. Cells grow beyond that, and are dealt out to more trees.
PIVOTS = 1024
#: Bounds are this much wider than computed, far more than rounding can do.
SLACK = 1e-6
#: The score of no entry.
NONE = -(1 << 63)
#: No product exceeds the largest squared norm, so all fit a long if it is below this (2^63, less what
#: summing doubles may round).
LARGEST = 2.0**63 * (1 - 2.0**-40)

_PAGE = ("cell int, tree int, page int, parent int, leaf boolean, router binary, radius double, "
         "to_parent double, rows binary, ids array<bigint>, vectors binary, to_router binary")


def quantised(embeddings: DataFrame) -> DataFrame:
    """row, vec_id and vector, floor(256 x) of each component, of the vectors that take part."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) < float("inf")))
    return embeddings.filter(F.col("embedding").isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        scaled.alias("vector"))


@dataclass(frozen=True)
class Space:
    """Components of the longest vector, shorter ones being filled up with zeros, and M."""

    size: int
    largest: float
    exact: bool  # whether products are exact as doubles

    def matrix(self, vectors) -> np.ndarray:
        out = np.zeros((len(vectors), self.size), np.int64)
        for i, vector in enumerate(vectors):
            out[i, :len(vector)] = vector
        return out

    def lifted(self, matrix: np.ndarray) -> np.ndarray:
        """Stored vectors with their further component."""
        norms = (matrix.astype(float) ** 2).sum(axis=1)
        return np.column_stack([matrix, np.sqrt(np.maximum(self.largest - norms, 0))]).astype(float)

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64) if self.exact else a @ b.T


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0))


def _clusters(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of points by their nearest router; equal points are cut up evenly."""
    count = min(most, -(-len(points) // LEAF))
    routers = points[np.linspace(0, len(points) - 1, count).astype(int)]
    nearest = distances(points, routers).argmin(axis=1)
    groups = [np.flatnonzero(nearest == i) for i in range(count)]
    groups = [g for g in groups if len(g)]
    return groups if len(groups) > 1 else np.array_split(np.arange(len(points)), count)


def pages(points: np.ndarray) -> Iterator[dict]:
    """The pages of one tree, each with the places of its entries."""
    numbers = itertools.count()
    waiting = [(np.arange(len(points)), -1, None)]
    while waiting:
        places, parent, above = waiting.pop()
        own = points[places]
        router = own[distances(own, own.mean(axis=0, keepdims=True))[:, 0].argmin()]
        to_router = distances(own, router[None])[:, 0]
        number, leaf = next(numbers), len(places) <= LEAF
        yield {
            "page": number, "parent": parent, "leaf": leaf, "router": router,
            "radius": float(to_router.max()), "places": places if leaf else places[:0],
            "to_parent": 0.0 if above is None else float(np.linalg.norm(router - above)),
            "to_router": to_router if leaf else to_router[:0],
        }
        if not leaf:
            waiting += [(places[g], number, router) for g in _clusters(own, FAN)]


def build(vectors: DataFrame, space: Space) -> DataFrame:
    """The pages of all trees, from row, vec_id, vector, cell and tree."""
    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        matrix = space.matrix(rows["vector"])
        numbers, ids = rows["row"].to_numpy(np.int64), rows["vec_id"].tolist()
        out = [{
            "cell": rows["cell"][0], "tree": rows["tree"][0], **page,
            "router": page["router"].tobytes(), "rows": numbers[page["places"]].tobytes(),
            "ids": [None if pd.isna(ids[i]) else int(ids[i]) for i in page["places"]],
            "vectors": matrix[page["places"]].tobytes(), "to_router": page["to_router"].tobytes(),
        } for page in pages(space.lifted(matrix))]
        return pd.DataFrame(out).drop(columns="places")[[c.split()[0] for c in _PAGE.split(", ")]]

    return vectors.groupBy("cell", "tree").applyInPandas(one, _PAGE)


def _reach(norms: np.ndarray, floor: np.ndarray, space: Space) -> np.ndarray:
    """How far away a vector can be and still have a score of at least `floor`."""
    whole = norms + space.largest
    reach = np.sqrt(np.maximum(whole - 2 * floor.astype(float), 0)) + SLACK * (1 + np.sqrt(whole))
    return np.where(floor == NONE, np.inf, reach)


class _Best:
    """The best entries of each query of a block so far, and how far away others may be."""

    def __init__(self, queries: np.ndarray, space: Space, most: int, worst: np.ndarray):
        self.norms = (queries.astype(float) ** 2).sum(axis=1)
        self.space, self.most = space, most
        self.found: list[list[tuple]] = [[] for _ in queries]
        self.floor = worst.copy()  # scores below can't be among the best
        self.reach = self._reach()

    def _reach(self) -> np.ndarray:
        return _reach(self.norms, self.floor, self.space)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: list, rows: np.ndarray) -> None:
        """Scores of the queries `at` (rows) and entries (columns)."""
        floor = self.floor[at]
        if scores.shape[1] > self.most:
            kth = np.partition(scores, -self.most, axis=1)[:, -self.most]
            floor = np.maximum(floor, kth)
        good = (scores >= floor[:, None]) & (scores != NONE)
        for i in np.flatnonzero(good.any(axis=1)):
            entries = [(-int(scores[i, j]), ids[j] is None, ids[j] or 0, int(rows[j]))
                       for j in np.flatnonzero(good[i])]
            best = heapq.nsmallest(self.most, self.found[at[i]] + entries)
            self.found[at[i]] = best
            if len(best) == self.most:
                self.floor[at[i]] = max(self.floor[at[i]], -best[-1][0])
        self.reach = self._reach()


def search(
    queries: np.ndarray, own: np.ndarray, worst: np.ndarray, tree: pd.DataFrame, space: Space,
    most: int,
) -> list[list[tuple]]:
    """For each query its best entries in one tree: (-score, no id, id, row), the best first.

    `own` are the queries' rows, which don't count for them, `worst` scores below which nothing is
    wanted. A page comes up once, in the order of the least bound of all queries, for
    those queries that it may still have something for.
    """
    best = _Best(queries, space, most, worst)
    lifted = np.column_stack([queries, np.zeros(len(queries))]).astype(float)
    page_at = {int(p): i for i, p in enumerate(tree["page"])}
    below: dict[int, list[int]] = {}
    for i, parent in enumerate(tree["parent"]):
        below.setdefault(int(parent), []).append(i)
    routers = np.stack([np.frombuffer(r, float) for r in tree["router"]])
    radius, to_parent = tree["radius"].to_numpy(float), tree["to_parent"].to_numpy(float)
    leaf, numbers = tree["leaf"].to_numpy(bool), tree["page"].to_numpy()

    def bounded(i: int, at: np.ndarray) -> tuple | None:
        """Page i with the distances of the queries `at` that may find something there."""
        away = distances(lifted[at], routers[i][None])[:, 0]
        bound = away - radius[i]
        near = bound <= best.reach[at]
        return (bound[near].min(), i, at[near], away[near]) if near.any() else None

    queue = [x for x in [bounded(page_at[0], np.arange(len(queries)))] if x]
    while queue:
        _, i, at, away = heapq.heappop(queue)
        near = away - radius[i] <= best.reach[at]  # others may have come nearer meanwhile
        at, away = at[near], away[near]
        if not len(at):
            continue
        if leaf[i]:
            entries = np.frombuffer(tree["vectors"].iloc[i], np.int64).reshape(-1, space.size)
            rows = np.frombuffer(tree["rows"].iloc[i], np.int64)
            to_router = np.frombuffer(tree["to_router"].iloc[i], float)
            # What the stored distance puts out of reach is not computed.
            wanted = np.abs(away[:, None] - to_router[None]) <= best.reach[at][:, None]
            some = wanted.any(axis=0)
            if not some.any():
                continue
            scores = space.products(queries[at], entries[some])
            scores[own[at][:, None] == rows[some][None]] = NONE
            ids = list(itertools.compress(tree["ids"].iloc[i], some))
            ids = [None if x is None or x != x else int(x) for x in ids]
            best.add(at, scores, ids, rows[some])
            continue
        for child in below.get(int(numbers[i]), []):
            # The distance to the child's router is bounded by that to this one's.
            possible = np.abs(away - to_parent[child]) - radius[child] <= best.reach[at]
            if possible.any() and (found := bounded(child, at[possible])):
                heapq.heappush(queue, found)
    return best.found


def query_blocks(asked: dict[int, int], pivots: np.ndarray) -> dict[int, tuple[int, int]]:
    """For each cell its first block and how many it has, from its number of queries.

    Cells that follow each other from nearest pivot to nearest pivot share a block until it is full,
    and a cell of more queries has several of its own. So there are about as many blocks as queries
    fill, and those of one block reach much the same trees.
    """
    left, at, chain = set(asked), None, []
    while left:
        near = sorted(left)
        at = near[0] if at is None else near[distances(pivots[[at]], pivots[near])[0].argmin()]
        left.remove(at)
        chain.append(at)
    blocks, block, held = {}, 0, 0
    for cell in chain:
        if held and held + asked[cell] > BLOCK:
            block, held = block + 1, 0
        blocks[cell] = (block, -(-asked[cell] // BLOCK) or 1)
        block, held = (block, held + asked[cell]) if asked[cell] <= BLOCK else (
            block + blocks[cell][1], 0)
    return blocks


def pages_asked_for(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The pages of each tree, once for each block that asks for it.

    `wanted` has cell, tree and block, one row for each that some query needs.
    """
    return index.join(wanted, ["cell", "tree"])


def _search_trees(
    queries: DataFrame, wanted: DataFrame, index: DataFrame, space: Space, most: int,
) -> DataFrame:
    """query, query_id, score, no_id, vec_id and row: the best of each tree for its queries.

    `queries` has row, vec_id, vector, floor (a score), block, cell and tree.
    """
    spread = pages_asked_for(index, stage(wanted, "wanted"))
    schema = "query long, query_id long, score long, no_id boolean, vec_id long, row long"

    def one(asked: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(tree):
            worst = asked["floor"].to_numpy(np.int64)
            rows, ids = asked["row"].to_numpy(np.int64), asked["vec_id"].to_numpy(np.int64)
            found = search(space.matrix(asked["vector"]), rows, worst, tree, space, most)
            out = [(row, name, -s, no, None if no else i, r) for row, name, best in zip(
                rows, ids, found, strict=True) for s, no, i, r in best]
        return pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    keys = ["cell", "tree", "block"]
    return queries.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(one, schema)


def _top(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "no_id", "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def top_products(embeddings: DataFrame, every: int = EVERY, best: int = BEST) -> DataFrame:
    """query_id, rank, vec_id, score: the largest inner products of every `every`th vector.

    Queries are the rows whose vec_id is divisible by `every`, candidates all rows but the query's
    own; ties go to the smaller vec_id. A vector that is null or holds null or non-finite components
    takes no part; vectors of unequal length are compared as if filled up with zeros. Products are
    exact. A vector whose squared norm, after scaling, leaves the range of a long raises a ValueError
    that names its vec_id, as its scores have no column that holds them. A row without vec_id is a candidate that comes after others of
    its score. Rows that repeat a vec_id are rows of their own, as queries too. An empty table gives
    an empty one; other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = stage(quantised(embeddings), "vectors")
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    top = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    count, size, largest, most = rows.agg(
        F.count(F.lit(1)), F.max(F.size("vector")), F.max(norm), F.max(top)).first()
    size, most = size or 0, most or 0
    if largest is not None and largest >= LARGEST:
        # Components beyond a long were set to its ends, so their norms are too large as well.
        worst = rows.filter(norm >= LARGEST).orderBy("vec_id").first()
        raise ValueError(f"the vector of vec_id {worst.vec_id} is too large for scores in a long")
    space = Space(size, largest or 0.0, size * most * most < 1 << 52)
    # A bounded sample, by a hash of the row: at most PIVOTS vectors.
    wanted = min(PIVOTS, -(-count // TREE)) or 1
    pivots = rows.orderBy(F.xxhash64("row")).limit(wanted).select("vector").collect()
    routing = space.lifted(space.matrix([p.vector for p in pivots] or [[]]))
    shared = spark.sparkContext.broadcast(routing)

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            away = distances(space.lifted(space.matrix(batch["vector"])), shared.value)
            yield batch.assign(cell=away.argmin(axis=1), away=away.min(axis=1))

    vector = "row long, vec_id long, vector array<bigint>"
    celled = stage(rows.mapInPandas(to_cells, f"{vector}, cell int, away double"), "cells")
    # One row per pivot: how many trees its cell has, and how far its vectors are from it.
    cells = celled.groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / TREE).cast("int").alias("trees"),
        F.max("away").alias("radius"),
        F.count_if((F.col("vec_id") % every) == 0).alias("asked")).collect()
    trees = {c.cell: c.trees for c in cells}
    radius = {c.cell: c.radius for c in cells}
    blocks = query_blocks({c.cell: c.asked for c in cells}, routing)
    layout = spark.createDataFrame(
        [(c, trees[c], *blocks[c]) for c in trees], "cell int, trees int, first int, blocks int")
    tree_count = F.create_map(*[F.lit(x) for c in trees for x in (c, trees[c])]) if trees else (
        F.create_map(F.lit(0), F.lit(1)))
    every_tree = F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree")
    in_trees = celled.withColumn("tree", F.pmod(
        F.xxhash64("row"), tree_count[F.col("cell")]).cast("int")).drop("away")
    index = stage(build(in_trees, space), "pages")

    # The layout has a row per pivot, so it is small.
    asked = celled.filter((F.col("vec_id") % every) == 0).join(F.broadcast(layout), "cell").select(
        "row", "vec_id", "vector", "cell", "trees", (F.col("first") + F.pmod(
            F.xxhash64("row", F.lit(1)), F.col("blocks"))).cast("int").alias("block"))
    home = asked.select("row", "vec_id", "vector", F.lit(NONE).cast("long").alias("floor"), "block",
                        "cell", every_tree)
    at_home = asked.select("cell", "trees", "block").distinct().select("cell", "block", every_tree)
    first = stage(_top(_search_trees(home, at_home, index, space, best), best), "nearest")

    worst = first.filter(F.col("rank") == best).select(F.col("query").alias("row"), F.col("score"))
    bounded = asked.join(worst, "row", "left").select(
        "row", "vec_id", "vector", F.coalesce("score", F.lit(NONE).cast("long")).alias("floor"),
        "block", "cell")

    def elsewhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query with the cells that may hold something better; not its own."""
        for batch in batches:
            queries = space.matrix(batch["vector"]).astype(float)
            norms = (queries**2).sum(axis=1)
            reach = _reach(norms, batch["floor"].to_numpy(np.int64), space)
            away = distances(np.column_stack([queries, np.zeros(len(queries))]), shared.value)
            near = np.stack([away[:, cell] - radius[cell] <= reach for cell in trees], axis=1)
            near &= batch["cell"].to_numpy()[:, None] != np.array(list(trees))[None]
            yield batch.drop(columns="cell").assign(
                cells=[list(itertools.compress(trees, row)) for row in near])

    further = stage(bounded.mapInPandas(
        elsewhere, f"{vector}, floor long, block int, cells array<int>"), "further")
    reached = further.select("block", F.explode("cells").alias("cell")).distinct().join(
        F.broadcast(layout), "cell").select("cell", "block", every_tree)
    spread = further.select("row", "vec_id", "vector", "floor", "block",
                            F.explode("cells").alias("cell"))
    spread = spread.join(F.broadcast(layout.select("cell", "trees")), "cell").select(
        "row", "vec_id", "vector", "floor", "block", "cell", every_tree)
    second = _search_trees(spread, reached, index, space, best)
    return _top(first.drop("rank").unionByName(second), best).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
