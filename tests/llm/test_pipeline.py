from collections import Counter

import corpus_pipeline
import pytest
from pitlane.llm.exact_dedup import exact_duplicates
from pitlane.llm.queries import QUERIES, SQL
from .support import document_table, texts

SF = "/root/testdata/sf0.001"


def test_registered():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")]
    assert sorted(numbers) == list(range(1, 11)) and "pipeline" in QUERIES
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_return_the_columns_of_documents(spark, edge, empty, stage):
    _, docs = edge
    out = stage[1](spark, docs, SF)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert out.count() <= docs.count()
    assert stage[1](spark, empty, SF).collect() == []


def test_the_last_stage_packs(spark, edge):
    _, docs = edge
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns)


def test_run_is_its_stages(spark):
    """The whole run against each stage's decision, made on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, left, SF).collect(), docs.schema)
        assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in left.collect()}
        left = after
    assert exact_duplicates(left).filter("not kept").count() == 0
    found = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    assert found == {r.doc_id for r in left.collect()}
    assert 0 < len(found) < docs.count()


def test_copies_go_and_clean_documents_stay(spark):
    plain = texts(seed=9, count=40)
    rows = list(enumerate(plain)) + [(100 + i, t + " ") for i, t in enumerate(plain[:7])]
    docs = document_table(spark, rows)
    out = corpus_pipeline.dedup(spark, docs, SF)
    kept = Counter(r.doc_id for r in out.collect())
    assert kept[3] == 1 and set(kept) >= set(range(40))
