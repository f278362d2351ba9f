"""Ranked lexical search for many items at once, which shares what items have in common.

Items are bags of terms, and a document's score for an item is a sum over the bag. Terms that stand
in the same items, as often, are one shared set. Of the sets that remain, the two that most items hold
together become one node, and so on while two items share a pair. So the items are a graph of sums: its
leaves are the partial accumulators of a document, computed once from its terms, and every item is
combined from nodes that others use too. Mining decides what is shared and never what a score is.

Documents are read once for their lengths and for the terms that items ask for. Both are written, as the
weights need the whole corpus; then each task scores its documents and keeps the best of each item.
"""

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pitlane.llm.common import stage
from pitlane.sources.tables import stack

TOP = 20
#: Different terms of the items that are answered together; one item may have more by itself.
BLOCK_TERMS = 50_000
#: Sets are paired with the sets that are about as common, so many to a window.
WINDOW = 64
#: Accumulators that a task holds at once.
CELLS = 4_000_000
#: Best rows of an item are chosen in so many parts first.
PARTS = 64

# Letters, digits and everything beyond ASCII make terms; only A-Z are lower-cased.
_NO_TERM = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
_FOLD = bytes(32 if _NO_TERM.match(bytes([b])) else b + 32 if 65 <= b <= 90 else b
              for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text in their order, in UTF-8; none for null."""
    return (text or "").encode().translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


# --- what items share ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Sharing:
    """A graph of sums. Leaves are term sets, `pairs` make the nodes after them, items sum nodes.

    `leaves` has (leaf, term, times) for every term of every set.
    """

    leaves: list[tuple[int, int, int]]
    n_leaves: int
    pairs: list[tuple[int, int]]
    items: list[list[int]]


def share(bags: list[dict[int, int]]) -> Sharing:
    """The graph for bags of {term: times}; empty bags have no nodes."""
    holders: dict[tuple[int, int], list[int]] = defaultdict(list)
    for item, bag in enumerate(bags):
        for element in bag.items():
            holders[element].append(item)
    sets: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
    for element, items in holders.items():
        sets[tuple(items)].append(element)

    # Common sets first, so a window holds sets that may well meet.
    order = sorted(sets, key=lambda items: (-len(items), items))
    leaves = [(leaf, *element) for leaf, items in enumerate(order) for element in sets[items]]
    window = {leaf: leaf // WINDOW for leaf in range(len(order))}
    held: list[dict[int, set[int]]] = [defaultdict(set) for _ in bags]
    for leaf, items in enumerate(order):
        for item in items:
            held[item][window[leaf]].add(leaf)

    together: dict[tuple[int, int], set[int]] = defaultdict(set)
    for item, windows in enumerate(held):
        for nodes in windows.values():
            members = sorted(nodes)
            for i, a in enumerate(members):
                for b in members[i + 1:]:
                    together[a, b].add(item)
    waiting = [(-len(items), pair) for pair, items in together.items() if len(items) > 1]
    heapq.heapify(waiting)
    pairs: list[tuple[int, int]] = []
    while waiting:
        count, (a, b) = heapq.heappop(waiting)
        items = together[a, b]
        if len(items) < 2:
            continue
        if len(items) != -count:
            heapq.heappush(waiting, (-len(items), (a, b)))
            continue
        new = len(order) + len(pairs)
        window[new] = window[a]
        pairs.append((a, b))
        for item in list(items):
            nodes = held[item][window[a]]
            nodes -= {a, b}
            for other in nodes:
                for old in (a, b):
                    together[min(old, other), max(old, other)].discard(item)
                together[other, new].add(item)
            nodes.add(new)
        del together[a, b]
        met = {other for item in items for other in held[item][window[a]] if other != new}
        for other in met:
            if len(together[other, new]) > 1:
                heapq.heappush(waiting, (-len(together[other, new]), (other, new)))
    return Sharing(leaves, len(order), pairs,
                   [sorted(n for nodes in windows.values() for n in nodes) for windows in held])


# --- documents ----------------------------------------------------------------------------------

def _postings(docs: DataFrame, wanted: dict[bytes, int]) -> DataFrame:
    """doc_id, n terms, and the wanted terms with how often each occurs; documents without terms go."""
    id_field = docs.schema["doc_id"]
    schema = T.StructType([
        id_field, T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("times", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)
    shipped = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shipped.value
        for batch in batches:
            texts = batch.column("text")
            rows, lengths, found, times = [], [], [], []
            for i in range(batch.num_rows):
                words = terms(texts[i].as_py())
                if words:
                    counted = Counter(words)
                    hit = counted.keys() & numbers.keys()
                    rows.append(i)
                    lengths.append(len(words))
                    found.append([numbers[t] for t in hit])
                    times.append([counted[t] for t in hit])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())),
                 *[pa.array(values, field.type)
                   for values, field in zip((lengths, found, times), list(arrow)[1:])]],
                schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class _Scorer:
    """Scores of documents for all items of a block."""

    def __init__(self, sharing: Sharing, weights: list[int], documents: int, length: int):
        self.sharing, self.documents, self.length = sharing, documents, length
        self.weights = np.array(weights, np.int64)
        uses = np.array(sorted((t, leaf, times) for leaf, t, times in sharing.leaves),
                        np.int64).reshape(-1, 3)
        self.leaf, self.factor = uses[:, 1], uses[:, 2]
        self.first = np.searchsorted(uses[:, 0], np.arange(len(weights) + 1))
        self.nodes = sharing.n_leaves + len(sharing.pairs)

    def scores(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """(item, document) scores; postings are given by document place, term and frequency."""
        m = 75 + 25 * n * self.documents // self.length
        value = self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
        # Each posting goes to every set that its term is in.
        copies = self.first[term + 1] - self.first[term]
        at = np.repeat(self.first[term] - np.cumsum(copies) + copies, copies) + np.arange(copies.sum())
        accumulators = np.zeros((self.nodes, len(n)), np.int64)
        np.add.at(accumulators, (self.leaf[at], np.repeat(doc, copies)),
                  np.repeat(value, copies) * self.factor[at])
        for place, (a, b) in enumerate(self.sharing.pairs, self.sharing.n_leaves):
            np.add(accumulators[a], accumulators[b], out=accumulators[place])
        return np.stack([accumulators[nodes].sum(axis=0) if nodes else np.zeros(len(n), np.int64)
                         for nodes in self.sharing.items])


class _Best:
    """The best documents of each item so far: highest score, then smallest id, none last."""

    def __init__(self, items: int, top: int):
        self.kept: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # a score below it does not enter
        self.top = top

    def add(self, scores: np.ndarray, ids: list) -> None:
        """`ids` ascend, none last."""
        enters = scores >= self.least[:, None]
        for item in np.flatnonzero(enters.any(axis=1)):
            places = np.flatnonzero(enters[item])
            own = scores[item, places]
            chosen = places[np.argsort(-own, kind="stable")[:self.top]]
            rows = self.kept[item] + [(int(scores[item, p]), ids[p]) for p in chosen]
            rows.sort(key=lambda row: (-row[0], row[1] is None, 0 if row[1] is None else row[1]))
            self.kept[item] = rows[:self.top]
            if len(rows) >= self.top:
                self.least[item] = self.kept[item][-1][0]


def _best_by_task(
    postings: DataFrame, scorer: _Scorer, numbers: list[int], top: int,
) -> DataFrame:
    """(item, doc_id, score): of each task, the best documents of each item."""
    schema = T.StructType([T.StructField("item", T.LongType()), postings.schema["doc_id"],
                           T.StructField("score", T.LongType())])
    arrow = to_arrow_schema(schema)
    shipped = postings.sparkSession.sparkContext.broadcast((scorer, numbers))
    at_once = max(1, CELLS // max(1, scorer.nodes + len(numbers)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, items = shipped.value
        best = _Best(len(items), top)
        for whole in batches:
            for begin in range(0, whole.num_rows, at_once):
                batch = whole.slice(begin, at_once)
                batch = batch.take(pc.sort_indices(
                    batch.column("doc_id"), null_placement="at_end"))
                lists, times = batch.column("terms"), batch.column("times")
                size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                best.add(work.scores(
                    batch.column("n").to_numpy(), np.repeat(np.arange(batch.num_rows), size),
                    lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                    times.flatten().to_numpy(zero_copy_only=False)), batch.column("doc_id").to_pylist())
        rows = [(items[i], doc, score) for i, kept in enumerate(best.kept) for score, doc in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[c] for row in rows], field.type) for c, field in enumerate(arrow)],
            schema=arrow)

    return postings.mapInArrow(run, schema)


def _first_rows(rows: DataFrame, by: list, top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple[object, dict[bytes, int]]]]:
    """Items with their bags of terms, as many at a time as have `most` different terms."""
    block, different = [], set()
    for row in items.select("item_id", "text").toLocalIterator():
        bag = Counter(terms(row.text))
        if block and len(different | bag.keys()) > most:
            yield block
            block, different = [], set()
        block.append((row.item_id, bag))
        different |= bag.keys()
    if block:
        yield block


def _answers(docs: DataFrame, block: list, name: T.StructField, top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of one block of items, numbered by their place."""
    wanted = {term: n for n, term in enumerate(sorted(set().union(*(bag for _, bag in block))))}
    postings = stage(_postings(docs, wanted), "postings")
    corpus = postings.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    holding = [0] * len(wanted)
    # One row per term of the block at most.
    for row in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[row.term] = row["count"]
    sharing = share([{wanted[term]: times for term, times in bag.items()} for _, bag in block])
    scorer = _Scorer(sharing, [weight(corpus.documents, n) for n in holding], corpus.documents,
                     corpus.length or 1)
    found = stage(_best_by_task(postings, scorer, list(range(len(block))), top), "best")
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    first = _first_rows(found.withColumn("part", part), ["item", "part"], top).drop("rank", "part")
    names = docs.sparkSession.createDataFrame(
        [(n, item) for n, (item, _) in enumerate(block)],
        T.StructType([T.StructField("item", T.LongType()), name]))
    # The names are those of one block, which the driver holds anyway.
    return _first_rows(first, ["item"], top).join(F.broadcast(names), "item").select(
        "item_id", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item_id, rank from 1, doc_id, score: each item's `top` documents of a score above zero.

    Equal scores go by ascending doc_id, none last. Null texts have no terms; documents without terms
    count nowhere. Every row of items is an item of its own, repeated and nameless ones too; one
    without terms has no rows, and so has every item if no document has terms. Repeated rows of
    documents are ranked each by itself. Other columns are not read.

    The driver holds the terms of one block of items and their document counts, never documents. Each
    block is a pass over the documents.
    """
    name = items.schema["item_id"]
    found = [_answers(docs, block, name, top) for block in _blocks(items, block_terms)]
    if found:
        return stack(found)
    return docs.sparkSession.createDataFrame([], T.StructType([
        name, T.StructField("rank", T.IntegerType()), docs.schema["doc_id"],
        T.StructField("score", T.LongType())]))
