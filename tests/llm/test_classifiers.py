import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlane.llm import toxicity
from pitlane.llm.linear import Leader, log_odds, sigmoid, train
from pitlane.llm.quality import (
    features, keep_good, labelled_texts, places, quality_scores, scorer, shape,
)
from pitlane.llm.toxicity import VOTERS, LabelModel, toxicity_scores, unpacked
from .support import document_table

SF = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def ranked_right(pairs):
    """Share of pairs of a good and a bad one that the score tells apart."""
    ones, zeros = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


def test_ftrl_against_its_formula():
    model = Leader(3, rate=0.5, smooth=1.0, l1=0.1, l2=0.2, offset=0.3)
    sums, squares = np.zeros(3), np.zeros(3)
    r = np.random.default_rng(0)
    for _ in range(40):
        x, y = r.normal(size=3), float(r.integers(2))
        w = np.array([0.0 if abs(z) <= 0.1 else -(z - np.sign(z) * 0.1) / (
            (1.0 + np.sqrt(n)) / 0.5 + 0.2) for z, n in zip(sums, squares, strict=True)])
        g = (sigmoid(0.3 + w @ x) - y) * x
        sums += g - (np.sqrt(squares + g * g) - np.sqrt(squares)) / 0.5 * w
        squares += g * g
        model.learn(np.arange(3), x, y)
    assert np.allclose(model.sums, sums) and np.allclose(model.squares, squares)


def test_training_separates():
    r = np.random.default_rng(1)
    data = [(np.array([i % 2, 2 + int(r.integers(5))]), np.ones(2), float(i % 2)) for i in range(200)]
    weights = train(data, 8, 5, l1=0.0, l2=0.0)
    assert weights[1] > 0.5 > -0.5 > weights[0]
    assert log_odds([1, 1, 1, 0]) == pytest.approx(np.log(2))


def test_shapes():
    assert [shape(w) for w in ("Word,", "THE!!", "a1b22", "x&&&", "día")] == [
        "Aa,", "A!!", "a0a0", "a&&", "a"]
    at, n = places("")
    assert len(at) == 0 and n == 0
    at, values = features("one two two")
    assert values.sum() == pytest.approx((4 * 3 - 2) / 3) and len(set(at)) == len(at)


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_quality_on_held_out_labels(tables):
    docs, labels = tables
    found = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == (crc(i) % 4 == 2) for i, r in found.items())
    pairs = [(found[x.doc_id].score, x.quality) for x in labels.collect() if found[x.doc_id].held_out]
    assert len(pairs) > 60 and ranked_right(pairs) > 0.97
    assert np.mean([(s >= 0.7) == y for s, y in pairs]) > 0.95
    assert all(r.predicted == (r.score >= 0.7) for r in found.values())


def test_toxicity_on_held_out_labels(tables):
    docs, labels = tables
    found = {r.doc_id: r for r in toxicity_scores(docs, labels).collect()}
    assert all(r.held_out == (crc(i) % 3 == 1) for i, r in found.items())
    pairs = [(found[x.doc_id].score, x.toxic) for x in labels.collect() if found[x.doc_id].held_out]
    assert ranked_right(pairs) > 0.85
    assert np.mean([(s >= 0.7) == y for s, y in pairs]) > 0.93


def odd_labels(spark, rows):
    good = [(i, 0 if i % 5 == 0 else 1, i % 2, "x", 0.5) for i, _ in rows if i is not None]
    return spark.createDataFrame(
        good + [(None, 1, 1, "x", 0.1), (1, None, None, "x", 0.2), (2, 0, 1, "x", 0.2), (3, 7, 7, "y", 0.1),
                (99_999, 1, 1, "x", 0.0)],
        "doc_id long, quality int, toxic int, text string, score double")


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_odd_rows_are_scored(edge, spark, scores):
    rows, docs = edge
    found = scores(docs, odd_labels(spark, rows)).collect()
    assert sorted(map(repr, (r.doc_id for r in found))) == sorted(repr(i) for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in found)


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_no_labels_and_no_documents(edge, empty, spark, scores):
    rows, docs = edge
    none = odd_labels(spark, rows).limit(0)
    assert {r.score for r in scores(docs, none).collect()} == {0.5}
    assert scores(empty, none).collect() == []


def test_good_ones_stay_whole(spark):
    r = random.Random(7)
    good = lambda: " ".join(r.choice("the of and to a in is it".split()) for _ in range(40))
    bad = lambda: " | ".join(r.choice("XX YY$$$ %%% ###".split()) for _ in range(40))
    rows = [(i, good() if i % 3 else bad()) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)], "doc_id long, quality int")
    docs = document_table(spark, rows)
    kept = keep_good(docs, labels, 0.7)
    assert kept.columns == docs.columns
    assert {x.doc_id for x in kept.collect()} == {i for i in range(200) if i % 3}


def test_score_is_a_mean_over_the_text():
    weights = np.zeros((1 << 18) + 1)
    weights[:-1] = np.random.default_rng(0).normal(size=1 << 18)
    score = scorer(weights)
    assert score("") == 0.5
    assert score("a b " * 500) == pytest.approx(score("a b " * 2000), abs=0.02)


def test_label_model_finds_accuracies_and_ties():
    """Votes made by known voters, of which the first two copy each other."""
    r = np.random.default_rng(5)
    n, truth = 20_000, None
    truth = r.random(n) < 0.2
    right = [0.9, 0.9, 0.8, 0.95, 0.7, 0.85, 0.8][:VOTERS]
    votes = np.stack([np.where(r.random(n) < a, truth, ~truth) * 2 for a in right], axis=1)
    votes[:, 1] = np.where(r.random(n) < 0.95, votes[:, 0], votes[:, 1])
    votes[r.random((n, VOTERS)) < 0.1] = 1
    at, counts = np.unique(votes @ 3 ** np.arange(VOTERS), return_counts=True)
    none = np.zeros(len(at))
    model = LabelModel(unpacked(at), counts, none, none)
    assert model.prior[1] == pytest.approx(0.2, abs=0.02)
    assert np.allclose(model.accuracies()[2:], right[2:], atol=0.03)
    ties = {frozenset((v, p)) for v, p in enumerate(model.parents) if p >= 0}
    assert frozenset((0, 1)) in ties
    guessed = model.posterior(votes)[:, 1] > 0.5
    assert (guessed == truth).mean() > 0.95


def test_votes_count_over_all_documents(edge, spark):
    rows, docs = edge
    labels = odd_labels(spark, rows)
    model = toxicity.count_votes(docs, labels, {"0:idiot": 0, "4:idio": 3})
    assert model.counts.sum() + model.known.sum() == len(rows)


def test_a_passage_in_a_long_text_is_voted_toxic():
    bad = ["idiot", "moron", "loser", "scum", "clown"]
    reader = toxicity.Reader({f"0:{w}": n % 3 for n, w in enumerate(bad)} | {"4:idio": 3, "5:moron": 4})
    body = ["word"] * 20_000
    passage = (["idiot", "moron", "loser", "it"] * 7)[:25] + ["is"] * 25
    for place in (0, 9_000, 20_000):
        votes = reader.read(" ".join(body[:place] + passage + body[place:]))[1]
        assert (votes[[0, 1, 2, 3, 4, VOTERS - 1]] == 2).all()
    # As many hits far apart, or fewer together, are no passage.
    apart = " ".join(w for n in range(19) for w in ["idiot"] + ["word"] * 1_000)
    assert reader.read(apart)[1].max() < 2
    assert reader.read(" ".join(body + ["idiot"] * (toxicity.STRETCH_HITS - 1)))[1].max() < 2
    assert (reader.read(" ".join(body))[1] == 0).all()


def test_copies_count_once_in_the_lexicons(spark):
    """A third of the labelled rows copies one long text, whose words would fill a lexicon."""
    r = random.Random(11)
    long = " ".join(f"{n}filler" for n in range(toxicity.MOST_ENTRIES + 1_000))
    plain = lambda: " ".join(r.choice("the of and to a in is it".split()) for _ in range(20))
    rows = [(long, 1.0)] * 30 + [(f"{plain()} scum {n}", 1.0) for n in range(20)]
    rows += [(f"{plain()} {n}", 0.0) for n in range(40)]
    found = toxicity.lexicons(spark.createDataFrame(rows, "text string, target double"))
    assert "0:scum" in found and "0:7filler" not in found


def test_the_sample_is_drawn_from_labels_with_documents(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(2_000)], "doc_id long, quality int")
    docs = document_table(spark, [(i, f"text {i}") for i in [*range(0, 2_000, 100), 5_000, None]])
    for most, taken in ((10, 10), (100, 20)):
        assert labelled_texts(docs, labels, "quality", F.lit(True), most).count() == taken


def test_nothing_to_fit_on_is_an_error(edge, empty, spark):
    rows, docs = edge
    labels = odd_labels(spark, rows)
    for none in (labels.limit(0), labels.withColumn("quality", F.lit(None).cast("int")),
                 labels.filter("doc_id = 99999")):
        with pytest.raises(ValueError, match="no labelled document"):
            keep_good(docs, none, 0.7)
        assert keep_good(empty, none, 0.7).collect() == []
