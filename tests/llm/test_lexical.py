import math
import random
import re
from collections import Counter

import pytest

from pitlane.llm.lexical import rank_documents, share, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(UPPER))


def brute_force(rows, items, top=20):
    docs = [(i, words(t)) for i, t in rows]
    docs = [(i, w, Counter(w)) for i, w in docs if w]
    length, n = sum(len(w) for _, w, _ in docs), len(docs)
    out = Counter()
    for item, text in items:
        scored = []
        for i, w, tf in docs:
            m = 100 - 25 + 25 * len(w) * n // length
            score = 0
            for term in words(text):
                df = sum(term in c for _, _, c in docs)
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                score += weight * (1000000000 * tf[term] // (1000 * tf[term] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:top], 1):
            out[item, rank, i, -score] += 1
    return out


def test_terms():
    text = "A-b c3\x00ÄÉ_x [ok] naïve\x7fEnd it 東京"
    assert [t.decode() for t in terms(text)] == words(text)
    assert terms(None) == terms("") == terms(" \n.,") == []


def random_bags(seed, count=40):
    r = random.Random(seed)
    common = [r.sample(range(300), r.randint(2, 12)) for _ in range(8)]
    return [Counter(t for c in r.sample(common, r.randint(0, 3)) for t in c)
            + Counter(r.choices(range(300), k=r.randint(0, 10))) for _ in range(count)]


@pytest.mark.parametrize("seed", range(5))
def test_shared_sums_are_the_bags(seed):
    bags = random_bags(seed)
    plan = share(bags)
    sums = [Counter() for _ in range(plan.n_leaves)]
    for leaf, term, times in plan.leaves:
        sums[leaf][term] += times
    for a, b in plan.pairs:
        sums.append(sums[a] + sums[b])
    assert [sum((sums[n] for n in nodes), Counter()) for nodes in plan.items] == bags


def test_a_common_set_is_one_node():
    bags = [Counter({1: 1, 2: 1, 3: 1}), Counter({1: 1, 2: 1, 4: 2}), Counter({1: 1, 2: 1, 4: 2})]
    plan = share(bags)
    # {1, 2} and {4 twice} are sets; the second and third item share their sum.
    assert sorted(len([1 for leaf, _, _ in plan.leaves if leaf == n])
                  for n in range(plan.n_leaves)) == [1, 1, 2]
    assert len(plan.pairs) == 1 and plan.items[1] == plan.items[2] == [plan.n_leaves]


def test_no_pair_is_left_that_two_items_share():
    plan = share(random_bags(9))
    if plan.n_leaves <= 64:
        pairs = Counter((a, b) for nodes in plan.items for i, a in enumerate(nodes)
                        for b in nodes[i + 1:])
        assert max(pairs.values(), default=0) < 2


@pytest.fixture(scope="module")
def items(edge):
    rows, _ = edge
    texts = [t for _, t in rows if t]
    r = random.Random(5)
    made = [(n, " ".join(r.choices(words(r.choice(texts[:60])) or ["x"], k=r.randint(1, 30))))
            for n in range(25)]
    return made + [(30, None), (31, ""), (32, "absent nowhere"), (33, "the The THE"), (None, "the sun"),
                   (33, "Ünïcode 日本語 one"), (34, texts[0]), (35, texts[0])]


def test_ranks(spark, edge, items):
    rows, docs = edge
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items],
                                  "item_id long, text string, doc_id string, rank int")
    expected = brute_force(rows, items)
    found = rank_documents(docs, asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == expected
    assert Counter(map(tuple, rank_documents(docs, asked, block_terms=12).collect())) == expected
    few = rank_documents(docs, asked, top=2)
    assert Counter(map(tuple, few.collect())) == brute_force(rows, items, 2)


def test_empty_tables_and_text_ids(spark, edge, empty):
    _, docs = edge
    asked = spark.createDataFrame([("a", "the sun"), ("b", "sun")], "item_id string, text string")
    assert rank_documents(empty, asked).collect() == []
    assert rank_documents(docs, asked.limit(0)).collect() == []
    named = docs.selectExpr("cast(doc_id as string) doc_id", "text")
    assert {r.item_id for r in rank_documents(named, asked).collect()} == {"a", "b"}
