"""The registered queries as they are, on the smallest tables."""

import pytest

from checks.compare import differences, duck
from pitlane.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"pipeline"}))
def test_every_document_is_in_the_result(spark, name):
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = [r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()]
    assert set(found) == set(ids)
    assert len(found) == len(ids) or name.startswith("op8")
