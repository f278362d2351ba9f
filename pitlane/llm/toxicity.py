"""Toxicity by weak supervision.

Many weak voters look at each document: lexicons of whole words, patterns of word beginnings, and
how dense their hits are, in the whole text and in the densest stretch of it. A vote is toxic, clean
or none. How often each combination of votes occurs is counted over all documents, and a generative
label model is fitted to these counts: how accurate each voter is and, in a tree of the strongest
ties between voters of one class, how they correlate. Its posterior is the label that a linear
classifier on hashed words and votes is trained on.

The entries of the lexicons come from labelled documents that aren't held out, and so do the counts
that tell the label model which of its two classes is the toxic one.
"""

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.common import Remembered, map_texts, stage
from pitlane.llm.linear import log_odds, sigmoid, train
from pitlane.llm.quality import CUT, labelled_texts, remainder

#: Most labelled documents that lexicons are made from, and most documents that the classifier is
#: trained on; both are chosen by a hash of doc_id.
LABELLED = 16_384
TRAINED_ON = 8_192
#: Lengths of the word beginnings that are looked at.
BEGINNINGS = (4, 5, 6)
#: Whole-word lexicons that the entries are dealt out to.
LEXICONS = 3
#: Most entries of a kind, and the least that an entry needs: different toxic texts, and how much more
#: often it is in toxic ones.
MOST_ENTRIES = 4096
LEAST_TOXIC = 4
LEAST_LIFT = 6.0
#: Hits per thousand words from which a voter says toxic, and below which clean, and the least hits
#: that make it say toxic. A long text hits something by chance, so hits alone say little.
DENSE, SPARSE, LEAST_HITS = 4.0, 1.0, 2
#: A stretch of so many words that has so many hits is voted on by itself too, so that a passage
#: isn't lost in a long text; each voter says the worse of both.
STRETCH, STRETCH_HITS = 100, 5
BITS = 16
EPOCHS = 4
ROUNDS = 50

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
VOTERS = LEXICONS + len(BEGINNINGS) + 1
Entries = dict[str, int]


def core(word: str) -> str:
    """A word in lower case without the signs around it."""
    low = word.lower()
    return low if low.isalnum() else _EDGES.sub("", low)


def marks(word: str) -> list[str]:
    """What a lexicon can hold of a word: itself and its beginnings, each with its kind."""
    word = core(word)
    if not word:
        return []
    return [f"0:{word}"] + [f"{n}:{word[:n]}" for n in BEGINNINGS if len(word) >= n]


def lexicons(sample: DataFrame) -> Entries:
    """Entry -> the number of its voter, from labelled texts (target, text).

    Equal texts count as one, with the mean of their targets, so that copies don't fill the lexicons.
    They are counted by entry in the executors; what comes back is bounded.
    """
    sample = stage(
        sample.groupBy(F.sha2("text", 256).alias("digest"))
        .agg(F.avg("target").alias("target"), F.any_value("text").alias("text")), "labelled")
    schema = T.StructType([T.StructField("mark", T.StringType()), sample.schema["target"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(marks)
        for batch in batches:
            for text, target in zip(
                batch.column("text").to_pylist(), batch.column("target").to_pylist(), strict=True,
            ):
                found = sorted({m for word in set(text.split()) for m in known[word]})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([target] * len(found), pa.float64())],
                    ["mark", "target"])

    toxic, every = sample.agg(F.sum("target"), F.count(F.lit(1))).first()
    toxic = toxic or 0.0
    counted = sample.select("text", "target").mapInArrow(run, schema).groupBy("mark").agg(
        F.sum("target").alias("toxic"), (F.count(F.lit(1)) - F.sum("target")).alias("clean"))
    lift = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (every - toxic + 1))
    kind = F.substring_index("mark", ":", 1)
    best = stage(
        counted.filter((F.col("toxic") >= LEAST_TOXIC) & (lift >= LEAST_LIFT))
        .select("mark", kind.alias("kind"), (F.col("toxic") * F.log(lift)).alias("worth")),
        "entries")
    entries = {}
    for n, name in enumerate(["0", *map(str, BEGINNINGS)]):
        top = best.filter(F.col("kind") == name).orderBy(F.desc("worth"), "mark").limit(MOST_ENTRIES)
        for row in top.select("mark").collect():
            voter = zlib.crc32(row.mark.encode()) % LEXICONS if n == 0 else LEXICONS - 1 + n
            entries[row.mark] = voter
    return entries


class Reader:
    """Reads texts: hashed words and beginnings, hits of each voter's entries, and votes."""

    def __init__(self, entries: Entries):
        self.whole: dict[str, int] = {}
        self.beginnings: list[tuple[int, dict[str, int]]] = [(n, {}) for n in BEGINNINGS]
        kinds = {"0": self.whole, **{str(n): found for n, found in self.beginnings}}
        for mark, voter in entries.items():
            kind, _, text = mark.partition(":")
            kinds[kind][text] = 1 << voter
        self.codes = Remembered(self._code)

    def _code(self, word: str) -> int:
        """Hashes of the word and of two beginnings, and a bit for each voter that it hits."""
        word = core(word)
        if not word:
            return 0
        hit = self.whole.get(word, 0)
        for n, found in self.beginnings:
            if len(word) >= n:
                hit |= found.get(word[:n], 0)
        hashes = [zlib.crc32(part.encode(), seed) >> 16 for seed, part in (
            (1, word), (2, word[:BEGINNINGS[0]]), (3, word[:BEGINNINGS[1]]))]
        return hit << 48 | hashes[0] << 32 | hashes[1] << 16 | hashes[2]

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(codes of the words, votes: 0 clean, 1 none, 2 toxic)."""
        words = text.split()
        codes = np.array(list(map(self.codes.__getitem__, words)), np.int64)
        hits = codes >> 48
        at = np.flatnonzero(hits > 0)
        hits = hits[at]
        votes = self._vote(hits, len(words))
        if len(hits) >= STRETCH_HITS:
            ends = np.searchsorted(at, at + STRETCH)
            dense = (ends - np.arange(len(at))).argmax()
            if ends[dense] - dense >= STRETCH_HITS:
                votes = np.maximum(votes, self._vote(hits[dense:ends[dense]], min(STRETCH, len(words))))
        return codes, votes

    @staticmethod
    def _vote(hits: np.ndarray, words: int) -> np.ndarray:
        """The votes on a number of words, from the voters that each hit in them is of."""
        per_voter = (hits[:, None] >> np.arange(VOTERS - 1) & 1).sum(axis=0)
        found = np.append(per_voter, len(hits))
        density = 1000 * found / max(words, 1)
        toxic = (density >= DENSE) & (found >= LEAST_HITS)
        return np.where(toxic, 2, np.where(density < SPARSE, 0, 1))

    def votes(self, text: str) -> int:
        """The votes as one number, three values a voter."""
        return int(self.read(text)[1] @ 3 ** np.arange(VOTERS))


_readers: dict[tuple, Reader] = {}


def reader_of(entries: Entries) -> Reader:
    """The reader of these entries; a Python worker keeps the last one for its next task."""
    key = tuple(sorted(entries.items()))
    if key not in _readers:
        _readers.clear()
        _readers[key] = Reader(entries)
    return _readers[key]


def unpacked(patterns: np.ndarray) -> np.ndarray:
    """Numbers of vote combinations -> a row of votes each."""
    return patterns[:, None] // 3 ** np.arange(VOTERS) % 3


class LabelModel:
    """P(class) and P(vote | class, vote of the voter it is tied to), fitted to counted votes.

    Without ties, voters are independent in a class; after a first fit the ties are chosen that
    explain most of what correlates, as a tree (no cycles), and the model is fitted again.
    """

    def __init__(self, votes: np.ndarray, counts: np.ndarray, toxic: np.ndarray, clean: np.ndarray):
        """Rows of votes with their number of unlabelled, toxic and clean documents."""
        self.votes, self.counts, self.known = votes, counts, np.stack([clean, toxic], axis=1)
        voters = votes.shape[1]
        self.parents = [-1] * voters
        lean = (votes - 1).mean(axis=1)
        self._fit(np.stack([0.5 - lean / 2.2, 0.5 + lean / 2.2], axis=1))
        self.parents = self._ties()
        self._fit(self.posterior(votes))

    def _fit(self, belief: np.ndarray) -> None:
        for _ in range(ROUNDS):
            weight = belief * self.counts[:, None] + self.known
            self.prior = (weight.sum(axis=0) + 1) / (weight.sum() + 2)
            self.tables = [self._table(weight, v, p) for v, p in enumerate(self.parents)]
            after = self.posterior(self.votes)
            if np.abs(after - belief).max(initial=0) < 1e-6:
                break
            belief = after

    def _table(self, weight: np.ndarray, voter: int, parent: int) -> np.ndarray:
        """P(vote | class, parent's vote); a voter says the right thing a little more often."""
        table = np.full((2, 3, 3), 0.1)
        table[0, :, 0] += 0.1
        table[1, :, 2] += 0.1
        given = self.votes[:, parent] if parent >= 0 else np.zeros(len(self.votes), int)
        for label in (0, 1):
            np.add.at(table[label], (given, self.votes[:, voter]), weight[:, label])
        return table / table.sum(axis=2, keepdims=True)

    def _ties(self) -> list[int]:
        """A maximum spanning tree over the mutual information of voters in a class."""
        weight = self.posterior(self.votes) * self.counts[:, None] + self.known
        voters = self.votes.shape[1]
        gain = np.zeros((voters, voters))
        for a in range(voters):
            for b in range(a):
                joint = np.full((2, 3, 3), 1e-3)
                for label in (0, 1):
                    np.add.at(joint[label], (self.votes[:, a], self.votes[:, b]), weight[:, label])
                joint /= joint.sum()
                apart = joint.sum(axis=1, keepdims=True) * joint.sum(axis=2, keepdims=True)
                apart /= joint.sum(axis=(1, 2), keepdims=True)
                gain[a, b] = gain[b, a] = (joint * np.log(joint / apart)).sum()
        parents, inside = [-1] * voters, [0]
        while len(inside) < voters:
            rest = [v for v in range(voters) if v not in inside]
            a, b = max(((a, b) for a in inside for b in rest), key=lambda x: gain[x])
            parents[b] = a
            inside.append(b)
        self.correlation = gain
        return parents

    def accuracies(self) -> np.ndarray:
        """How often each voter that votes is right, by the model."""
        weight = self.posterior(self.votes) * self.counts[:, None] + self.known
        right = [weight[self.votes[:, v] == 0, 0].sum() + weight[self.votes[:, v] == 2, 1].sum()
                 for v in range(self.votes.shape[1])]
        voted = [weight[self.votes[:, v] != 1].sum() for v in range(self.votes.shape[1])]
        return np.array(right) / np.maximum(voted, 1e-9)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(class | votes), a row each."""
        likely = np.tile(np.log(self.prior), (len(votes), 1))
        for voter, parent in enumerate(self.parents):
            given = votes[:, parent] if parent >= 0 else np.zeros(len(votes), int)
            for label in (0, 1):
                likely[:, label] += np.log(self.tables[voter][label, given, votes[:, voter]])
        likely = np.exp(likely - likely.max(axis=1, keepdims=True))
        return likely / likely.sum(axis=1, keepdims=True)


SIZE = 3 * (1 << BITS) + 3 * VOTERS


def _places(codes: np.ndarray) -> np.ndarray:
    kinds = [(codes >> shift & 0xFFFF) + i * (1 << BITS) for i, shift in enumerate((32, 16, 0))]
    return np.concatenate(kinds)


def _cast(votes: np.ndarray) -> np.ndarray:
    return 3 * (1 << BITS) + 3 * np.arange(VOTERS) + votes


def _values(counts: np.ndarray, words: int) -> np.ndarray:
    """Percent of the words, up to a bound."""
    return np.minimum(100 * counts / max(words, 1), 3.0)


def features(codes: np.ndarray, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and beginnings by their share of the words, and the votes."""
    at, counts = np.unique(_places(codes[codes != 0]), return_counts=True)
    values = np.concatenate([_values(counts, len(codes)), np.ones(VOTERS)])
    return np.concatenate([at, _cast(votes)]), values


def scorer(entries: Entries, weights: np.ndarray) -> Callable[[str], float]:
    reader, constant = reader_of(entries), float(weights[-1])

    def score(text: str) -> float:
        codes, votes = reader.read(text)
        at = _places(codes[codes != 0])
        at, counts = np.unique(at[weights[at] != 0], return_counts=True)
        margin = constant + weights[_cast(votes)].sum() + weights[at] @ _values(counts, len(codes))
        return float(sigmoid(margin))

    return score


def fitted(examples: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """The weights, and the log odds of the labels last."""
    prior = log_odds([target for _, _, target in examples])
    weights = train(examples, SIZE, EPOCHS, rate=0.3, l1=1.0, l2=0.1, offset=prior)
    return np.append(weights, prior)


def held_out():
    return remainder(3) == 1


def count_votes(docs: DataFrame, labels: DataFrame, entries: Entries) -> LabelModel:
    """The label model, from the votes on all documents.

    Votes are counted where they are cast; at most three to the power of the voters rows come back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(entries)
    known = labels.filter(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()
    ).groupBy("doc_id").agg(F.avg("toxic").alias("target"))

    def start():
        reader = reader_of(shared.value)
        return lambda text: (reader.votes(text),)

    cast = stage(map_texts(
        docs.select("doc_id", "text"), "text", [T.StructField("votes", T.IntegerType())], start,
    ), "votes")
    target = F.col("target")
    counted = cast.join(known, "doc_id", "left").groupBy("votes").agg(
        F.count(F.when(target.isNull(), 1)).alias("rest"),
        F.sum(F.coalesce(target, F.lit(0.0))).alias("toxic"),
        F.sum(F.coalesce(1 - target, F.lit(0.0))).alias("clean"),
    ).toPandas().sort_values("votes")
    return LabelModel(unpacked(counted["votes"].to_numpy()), counted["rest"].to_numpy(),
                      counted["toxic"].to_numpy(), counted["clean"].to_numpy())


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Entries, np.ndarray]:
    """The lexicons and the classifier's weights."""
    entries = lexicons(labelled_texts(docs, labels, "toxic", ~held_out(), LABELLED))
    if not entries:
        return entries, np.zeros(SIZE + 1)
    model = count_votes(docs, labels, entries)
    chosen = docs.select("doc_id").filter("doc_id is not null").distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(TRAINED_ON)
    sample = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"))
    )
    shared = docs.sparkSession.sparkContext.broadcast(entries)
    fields = [T.StructField("codes", T.ArrayType(T.LongType())),
              T.StructField("votes", T.ArrayType(T.LongType()))]

    def start():
        return reader_of(shared.value).read

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        targets = model.posterior(np.stack(rows["votes"].tolist()))[:, 1]
        weights = fitted([
            (*features(codes, votes), target)
            for codes, votes, target in zip(rows["codes"], rows["votes"], targets, strict=True)])
        used = np.flatnonzero(weights)
        return pd.DataFrame({"place": used, "weight": weights[used]})

    one = map_texts(sample, "text", fields, start).groupBy(F.lit("all").alias("sample"))
    found = one.applyInPandas(learn, "place long, weight double").toPandas()
    weights = np.zeros(SIZE + 1)
    weights[found["place"]] = found["weight"]
    return entries, weights


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A null id counts as an empty one when rows are held out, a null text as empty; repeated rows
    stay. Without labels that give a voter an entry the score is 0.5 for all.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def start():
        score = scorer(*shared.value)
        return lambda text: (score(text),)

    scored = map_texts(
        docs.select("doc_id", "text"), "text", [T.StructField("score", T.DoubleType())], start)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
