import math
import zlib
from collections import Counter
from hashlib import md5

from pitlane.llm.sharding import best_shard, place, shard_documents
from pyspark.sql import functions as F


def cost(key, shard, weight=1.0):
    draw = int(md5(f"{key}:{shard}".encode()).hexdigest()[:13], 16)
    return -math.log((draw + 0.5) / 2**52) / weight


def test_every_row_by_brute_force(edge):
    rows, docs = edge
    found = [tuple(r) for r in shard_documents(docs).collect()]
    expected = Counter()
    for i, text in rows:
        data, key = (text or "").encode(), "" if i is None else i
        of = lambda n: min(range(n), key=lambda s: cost(key, s))
        expected[i, len(data) + 16, zlib.crc32(data), "key", of(40), of(41)] += 1
    assert Counter((*r[:5], r[6]) for r in found) == expected
    for shard in {r[4] for r in found}:
        slots = sorted(r[5] for r in found if r[4] == shard)
        assert slots == list(range(len(slots)))


def test_growing_moves_rows_to_the_new_shard_only(spark):
    keys = spark.range(5000).withColumnRenamed("id", "doc_id")
    rows = place(keys, "doc_id", [1.0] * 10).collect()
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {10}
    assert 300 < len(moved) < 620
    grown = {r.doc_id: r.shard for r in place(keys, "doc_id", [1.0] * 11).collect()}
    assert all(grown[r.doc_id] == r.grown_shard for r in rows)


def test_weights(spark):
    keys = spark.range(6000).select(best_shard(F.col("id").cast("string"), [1.0, 3.0]).alias("w"))
    share = keys.filter("w.shard = 1").count() / 6000
    assert 0.72 < share < 0.78


def test_slots_do_not_depend_on_the_parts(spark):
    keys = spark.range(300).withColumnRenamed("id", "doc_id")
    one = place(keys, "doc_id", [1.0] * 3, parts=1).collect()
    many = place(keys.repartition(7), "doc_id", [1.0] * 3, parts=50).collect()
    assert sorted((r.shard, r.slot) for r in one) == sorted((r.shard, r.slot) for r in many)


def test_empty(empty):
    assert shard_documents(empty).collect() == []
