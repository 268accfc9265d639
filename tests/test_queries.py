"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from tools.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def own_queries():
    """All but the training-data operators, which tests/llm covers."""
    llm = re.compile(r"op\d+_|pipeline$")
    return sorted(name for name in entry.queries() if not llm.match(name))


@pytest.mark.parametrize("name", own_queries())
def test_query_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert difference(got, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["category", "n", "avg_cos"] and rows.count() > 0
