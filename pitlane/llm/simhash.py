"""SimHash near-duplicates: exact comparison of all fingerprints in tiles.

Equal fingerprints become one first. The distinct ones are laid out in tiles by the number of their
bits, and a pair of tiles is compared unless these numbers differ by more than the radius; inside,
fingerprints are sorted by the bits of their eight bytes, and blocks are skipped that can't be near
by these counts either. What is left is compared exactly, by exclusive-or and bit counts in numpy.
Of the links found in a pair of tiles a spanning forest goes on, which loses no link between
different texts' groups and never grows with the square of a group.
"""

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.common import id_keys, map_texts, stage
from pitlane.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in a tile: what is moved grows with the square of all of them over this.
TILE = 1 << 16
#: Fingerprints in a block, the unit of comparison inside a pair of tiles.
BLOCK = 256

#: Partitions for pairs of tiles; more pairs than this share them.
MOST_TASKS = 20_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_COUNT_AT_ONCE = 1 << 14


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; no words: zero."""
    words = _WORD.findall(text.encode().translate(_LOWER))
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[:len(words) - shingle + 1].tolist()
    ends = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)], dtype=np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _COUNT_AT_ONCE):
        part = hashes[at:at + _COUNT_AT_ONCE]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The other columns of docs and `fingerprint`, the 64 bits as a signed long."""
    def start():
        return lambda text: ((fingerprint(text, shingle) ^ 1 << 63) - (1 << 63),)

    return map_texts(docs, text, [T.StructField("fingerprint", T.LongType())], start)


def _byte_counts(prints: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8))


def _hook(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of linked nodes; the smaller root stays."""
    while len(a):
        a, b = _root(parent, a), _root(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _root(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    while True:
        up = parent[nodes]
        if (up == nodes).all():
            return nodes
        nodes = up


class _Tile:
    """Sorted fingerprints in blocks, each with the least and greatest bit count of every byte."""

    def __init__(self, prints: np.ndarray):
        counts = _byte_counts(prints)
        # Near counts next to each other: order by the bits of both halves, then of each byte.
        halves = counts.reshape(-1, 2, 4).sum(axis=2)
        order = np.lexsort([*counts.T, *halves.T])
        self.prints, counts = prints[order], counts[order].astype(np.int16)
        starts = np.arange(0, len(prints), BLOCK)
        self.starts = starts
        self.low = np.minimum.reduceat(counts, starts)
        self.high = np.maximum.reduceat(counts, starts)


def near_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> np.ndarray:
    """A spanning forest (two columns) of all pairs of fingerprints that differ in few bits.

    Compares left with right, or left with itself if there is no right.
    """
    one = _Tile(left)
    two = one if right is None else _Tile(right)
    shift = 0 if right is None else len(left)
    prints = one.prints if right is None else np.concatenate([one.prints, two.prints])
    parent = np.arange(len(prints))
    for i, start in enumerate(one.starts):
        apart = np.maximum(one.low[i] - two.high, two.low - one.high[i]).clip(0).sum(axis=1)
        near = np.flatnonzero(apart <= radius)
        if right is None:
            near = near[near >= i]
        mine = one.prints[start:start + BLOCK]
        for j in near:
            at = two.starts[j]
            bits = np.bitwise_count(mine[:, None] ^ two.prints[None, at:at + BLOCK])
            if bits.min() <= radius:
                a, b = np.nonzero(bits <= radius)
                _hook(parent, a + start, b + at + shift)
    roots = _root(parent, parent.copy())
    linked = np.flatnonzero(roots != np.arange(len(roots)))
    return np.stack([prints[linked], prints[roots[linked]]], axis=1)


def _tiles(prints: DataFrame, tile: int) -> DataFrame:
    """Distinct fingerprints packed into tiles: weight (bits set), part, prints (binary)."""
    weight = F.bit_count("fingerprint").alias("weight")
    counted = prints.select("fingerprint", weight)
    # One row per possible number of bits.
    parts = counted.groupBy("weight").agg(F.ceil(F.count(F.lit(1)) / tile).alias("parts"))
    dealt = counted.join(F.broadcast(parts), "weight").withColumn(
        "part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "weight": rows["weight"][:1], "part": rows["part"][:1], "parts": rows["parts"][:1],
            "prints": [rows["fingerprint"].to_numpy(np.int64).tobytes()],
        })

    return dealt.groupBy("weight", "part").applyInPandas(
        packed, "weight int, part long, parts long, prints binary")


def _pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """Each pair of tiles whose bit counts are near enough, named by the lighter and the heavier."""
    names = tiles.select("weight", "part")
    met = names.select(F.col("weight").alias("w1"), F.col("part").alias("p1"), F.explode(
        F.sequence(F.col("weight"), F.col("weight") + radius)).alias("weight"))
    met = met.join(names, "weight").select(
        "w1", "p1", F.col("weight").alias("w2"), F.col("part").alias("p2"))
    return met.filter("w1 < w2 or p1 <= p2")


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints at most `radius` bits apart, directly or
    through others that are. `prints` has one column, fingerprint, without repeats."""
    tiles = stage(_tiles(prints, tile), "tiles")
    pairs = _pairs(tiles, radius)
    # Little data and much work: as many partitions as pairs, which the planner leaves as they are.
    tasks = min(max(pairs.count(), 1), MOST_TASKS)
    sides = pairs.select("w1", "p1", "w2", "p2", F.explode(F.array(
        F.struct(F.col("w1").alias("weight"), F.col("p1").alias("part"), F.lit(0).alias("side")),
        F.struct(F.col("w2").alias("weight"), F.col("p2").alias("part"), F.lit(1).alias("side")),
    )).alias("one")).select("w1", "p1", "w2", "p2", "one.*")
    loaded = sides.join(tiles.select("weight", "part", "prints"), ["weight", "part"])
    pair = ["w1", "p1", "w2", "p2"]

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        sides = [np.frombuffer(x, np.uint64) for x in rows.sort_values("side")["prints"]]
        same = rows["w1"][0] == rows["w2"][0] and rows["p1"][0] == rows["p2"][0]
        found = near_links(sides[0], None if same else sides[1], radius).astype(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return loaded.repartition(tasks, *pair).groupBy(*pair).applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE,
) -> tuple[DataFrame, DataFrame]:
    """Rows with their fingerprint and text digest, and per fingerprint the component's root.

    The second has one row per distinct fingerprint: fingerprint, root. Texts are read once.
    """
    rows = docs.select(
        F.col("doc_id").alias("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"),
        F.col("text").alias("text"))
    rows = stage(fingerprints(rows, "text", shingle), "fingerprints")
    prints = rows.select("fingerprint").distinct()
    roots = components(fingerprint_links(prints, radius, tile))
    known = prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"))
    return rows, stage(known, "roots")


def near_duplicate_components(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that can be reached over links, null if all ids there are
    null. A null or empty text and one of white space only has fingerprint zero and is linked like
    any other. Repeated rows stay. An empty table gives an empty one; other columns are not read.
    """
    rows, roots = near_duplicates(docs, shingle, radius, tile)
    least = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).join(roots, "fingerprint")
    names = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.join(names, "root").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id")


def keep_one_each(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE,
) -> DataFrame:
    """The rows of docs, with all their columns, that come first in their component.

    The smallest doc_id comes first, null ids last; equal ids by the digest of their text; of rows
    equal in both any one stays. Texts are shuffled once, by id and digest.
    """
    rows, roots = near_duplicates(docs, shingle, radius, tile)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    by_print = rows.groupBy("fingerprint").agg(F.min(order).alias("first"))
    first = by_print.join(roots, "fingerprint").groupBy("root").agg(F.min("first").alias("first"))
    keys = ["id", "no_id", "digest"]
    staying = first.select("first.*").withColumns(id_keys("doc_id")).select(*keys)
    keyed = docs.select(
        F.struct("*").alias("row"), *[c.alias(n) for n, c in id_keys("doc_id").items()],
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return (
        keyed.join(staying, keys, "left_semi").withColumn("place", place).filter("place = 1")
        .select("row.*")
    )
