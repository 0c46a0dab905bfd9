"""Every registered query against its SQL, on the smallest given data set."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from checks.compare import differences, duck

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def connection():
    with duck(DATA) as made:
        yield made


#: The queries of the optional subpackage have tests of their own.
OWN = [name for name in entry_points.queries() if name not in entry_points.LLM_QUERIES]


def test_every_query_has_its_sql():
    assert set(OWN) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, connection, name):
    got = entry_points.queries()[name](spark, DATA).toPandas()
    assert differences(got, connection.sql(entry_points.oracle_sql()[name]).df()) is None


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0
