import hashlib
import re
from collections import Counter

from pitlane.llm.exact_dedup import drop_duplicates, exact_duplicates, rounds_of, tree_merge


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def groups(rows):
    found = {}
    for i, text in rows:
        found.setdefault(normal(text), []).append(i)
    return found


def test_every_document(edge):
    rows, docs = edge
    expected = Counter()
    for text, ids in groups(rows).items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        ids = sorted(ids, key=lambda i: (i is None, i))
        for place, i in enumerate(ids):
            expected[i, ids[0], len(ids), place == 0, digest] += 1
    assert Counter(map(tuple, exact_duplicates(docs).collect())) == expected


def test_one_row_of_each_stays_whole(edge):
    rows, docs = edge
    kept = drop_duplicates(docs)
    assert kept.columns == docs.columns
    found = [(r.doc_id, normal(r.text)) for r in kept.collect()]
    expected = [(min(ids, key=lambda i: (i is None, i)), t) for t, ids in groups(rows).items()]
    assert Counter(found) == Counter(expected)


def test_a_group_over_many_partitions_is_merged(spark):
    rows = spark.range(3000, numPartitions=40).selectExpr(
        "sha2(cast(id % 3 as string), 256) digest", "id % 3 proof", "id smallest")
    found = sorted((r.proof, r.smallest, r.copies) for r in tree_merge(rows).collect())
    assert found == [(0, 0, 1000), (1, 1, 1000), (2, 2, 1000)]


def test_rounds_follow_the_leaves(spark):
    """300 leaves need three rounds of sixteen; copies of a digest lie in all of them."""
    assert [rounds_of(n) for n in (0, 1, 2, 16, 17, 256, 257, 4096, 4097, 70_000)] == [
        1, 1, 1, 1, 2, 2, 3, 3, 4, 5]
    rows = spark.range(6000, numPartitions=300).selectExpr(
        "sha2(cast(id % 700 as string), 256) digest", "id % 700 proof", "id smallest")
    merged = tree_merge(rows)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 3
    expected = {p: (p, len(range(p, 6000, 700))) for p in range(700)}
    assert {r.proof: (r.smallest, r.copies) for r in merged.collect()} == expected
    assert merged.count() == 700


def test_digests_that_only_look_alike_stay_apart(spark):
    rows = spark.createDataFrame([("ab", 1, 5), ("ab", 2, 3), ("ab", 1, None)],
                                 "digest string, proof long, smallest long")
    found = sorted((r.proof, r.smallest, r.copies) for r in tree_merge(rows).collect())
    assert found == [(1, 5, 2), (2, 3, 1)]


def test_empty(empty):
    assert exact_duplicates(empty).collect() == []
    assert drop_duplicates(empty).collect() == []
