"""Every registered query against its SQL on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from checks.compare import differences, duck
from checks.registry import QUERIES, SQL


@pytest.fixture(scope="module")
def connection():
    return duck(TESTDATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    df = QUERIES[name](spark, TESTDATA)
    assert differences(df, connection, SQL[name]) == []
    assert not df.isEmpty()


@pytest.mark.parametrize("absent", ["ahocorasick", "corpus_pipeline", "pitlane.llm"])
def test_the_entry_does_without_the_corpus_operators(absent):
    code = (f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; "
            "print(sorted(e.queries()) == sorted(e.oracle_sql()), len(e.queries()))")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True,
                          cwd=Path(entry.__file__).parent, timeout=120)
    assert done.stdout.split() == ["True", str(len(QUERIES))], done.stderr


def test_comparison_sees_differences(spark, connection):
    df = spark.sql("SELECT 1L AS a, 'x' AS b")
    assert differences(df, connection, "SELECT CAST(1 AS BIGINT) AS a, 'x' AS b") == []
    assert differences(df, connection, "SELECT CAST(2 AS BIGINT) AS a, 'x' AS b")
    assert differences(df, connection, "SELECT 1 AS a, 'x' AS b")
    assert differences(df, connection, "SELECT CAST(1 AS BIGINT) AS a")
    assert differences(df, connection, "SELECT CAST(1 AS BIGINT) AS a, 'x' AS b WHERE FALSE")


def test_entry(spark):
    assert entry.entry(spark).count() == 1411
