"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from skyloom.catalog.queries import QUERIES
from compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert differences(queries()[name](spark, SF), connection, oracle_sql()[name]) == []


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "average_departure_delay" in df.columns
