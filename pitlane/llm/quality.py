"""Quality classifier: hashed word n-grams, logistic regression by FTRL, sparse dot products.

A document's features are its words and pairs of words, both as they are written and as shapes
(which kinds of characters follow one another), hashed into a fixed number of weights and divided by
the number of words. So the score is a mean of weights over the text, whatever its length.
"""

import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.common import Remembered, map_texts
from pitlane.llm.linear import log_odds, sigmoid, train

BITS = 18
#: Most labelled documents that the classifier is fitted on, chosen by a hash of doc_id.
TRAINED_ON = 8192
EPOCHS = 4
#: Scores from here on are predicted as label 1.
CUT = 0.7

#: Odd multipliers that spread four kinds of features over the weights.
_SPREAD = [np.uint64(k) for k in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_KIND = [(re.compile("[A-Z]+"), "A"), (re.compile("[0-9]+"), "0"), (re.compile(r"[^\W\d_A0]+"), "a"),
         (re.compile(r"(.)\1+"), r"\1\1")]


def shape(word: str) -> str:
    """Which kinds of characters follow one another: runs of letters or digits become one sign."""
    for pattern, sign in _KIND:
        word = pattern.sub(sign, word)
    return word


def _code(word: str) -> int:
    """The hash of the lower-case word and that of its shape, in one number."""
    return zlib.crc32(word.lower().encode()) << 32 | zlib.crc32(shape(word).encode())


_codes = Remembered(_code)


def places(text: str) -> tuple[np.ndarray, int]:
    """The weight of every feature of a text, repeats included, and the number of its words.

    A text without words has no features.
    """
    words = text.split()
    codes = np.array(list(map(_codes.__getitem__, words)), np.uint64)
    low = np.uint64(32)
    written, shapes = codes >> low, codes & np.uint64(0xFFFFFFFF)
    again = (written[1:] == written[:-1]).astype(np.uint64)
    mixed = np.uint64(0x2545F4914F6CDD1D)
    keys = [
        written * _SPREAD[0], (written[1:] * mixed + written[:-1]) * _SPREAD[1],
        shapes * _SPREAD[2] + np.uint64(1), (shapes[1:] * mixed + shapes[:-1] + again) * _SPREAD[3],
    ]
    return (np.concatenate(keys) >> np.uint64(64 - BITS)).astype(np.int64), len(words)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and values, the counts over the number of words."""
    at, n = places(text)
    at, counts = np.unique(at, return_counts=True)
    return at, counts / max(n, 1)


def fitted(examples: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """The weights, and the log odds of the labels last: what a text without features scores."""
    prior = log_odds([target for _, _, target in examples])
    weights = train(examples, 1 << BITS, EPOCHS, rate=30.0, l1=0.0005, l2=0.0, offset=prior)
    return np.append(weights, prior)


def scorer(weights: np.ndarray) -> Callable[[str], float]:
    hashed, constant = weights[:-1], float(weights[-1])

    def score(text: str) -> float:
        at, n = places(text)
        return float(sigmoid(constant + hashed[at].sum() / max(n, 1)))

    return score


def remainder(parts: int):
    """crc32 of the doc_id as text, modulo a number; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, usable, most: int,
) -> DataFrame:
    """doc_id, target and text of at most `most` labelled documents, chosen by a hash of doc_id.

    Only labels of ids that docs has are chosen from. Labels that aren't 0 or 1 and rows without an
    id are left out. An id with several labels has their mean, and one with several texts the
    smallest.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable).join(
        docs.select("doc_id"), "doc_id", "left_semi")
    chosen = (
        known.groupBy("doc_id").agg(F.avg(label).alias("target"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Of the bounded sample: one number and one id a row.
    met = texts.join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id", "target").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, usable, most: int = TRAINED_ON) -> np.ndarray | None:
    """The weights, trained in one task on the bounded sample; None if there is none."""
    fields = [T.StructField("at", T.ArrayType(T.IntegerType())),
              T.StructField("values", T.ArrayType(T.FloatType()))]
    sample = labelled_texts(docs, labels, "quality", usable, most)
    examples = map_texts(sample, "text", fields, lambda: features)
    size = (1 << BITS) + 1

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        data = [(at, values.astype(float), target) for at, values, target in zip(
            rows["at"], rows["values"], rows["target"], strict=True)]
        weights = fitted(data)
        used = np.union1d(np.flatnonzero(weights), size - 1)
        return pd.DataFrame({"place": used, "weight": weights[used]})

    one = examples.groupBy(F.lit("all").alias("sample"))
    found = one.applyInPandas(learn, "place long, weight double").toPandas()
    if found.empty:
        return None
    weights = np.zeros(size)
    weights[found["place"]] = found["weight"]
    return weights


def held_out():
    return remainder(4) == 2


def score_documents(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The other columns of docs and `score`. A null or empty text is scored by the share of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def start():
        score = scorer(shared.value)
        return lambda text: (score(text),)

    return map_texts(docs, "text", [T.StructField("score", T.DoubleType())], start)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Fitted on labelled documents that aren't held out, at most TRAINED_ON of them. Without any the
    score is 0.5 for all. A null id counts as an empty one, a null text too; repeated rows stay.
    """
    weights = fit(docs, labels, ~held_out())
    if weights is None:
        weights = np.zeros((1 << BITS) + 1)
    scored = score_documents(docs.select("doc_id", "text"), weights)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float) -> DataFrame:
    """The rows of docs, with all their columns, that the classifier scores at `cut` or above.

    Raises if there are documents but none with a usable label that isn't held out: nothing could be
    told about them then. An empty table gives an empty one.
    """
    weights = fit(docs, labels, ~held_out())
    if weights is None:
        if docs.isEmpty():
            return docs
        raise ValueError("no labelled document to fit the quality classifier on")
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    schema, place = docs.schema, docs.columns.index("text")

    def run(batches):
        score = scorer(shared.value)
        for batch in batches:
            kept = [score(text.as_py() or "") >= cut for text in batch.column(place)]
            yield batch.filter(kept)

    return docs.mapInArrow(run, schema)
