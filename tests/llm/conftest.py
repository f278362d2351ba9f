import pytest

from pitlane.llm.common import find_on_executors

from .support import document_table, edge_rows


@pytest.fixture(scope="session", autouse=True)
def executors(spark):
    find_on_executors(spark)


@pytest.fixture(scope="session")
def edge(spark):
    """(rows, table) with every odd case and clashing column names."""
    rows = edge_rows()
    return rows, document_table(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return document_table(spark, [])
