"""Every query of the library against its SQL, on the smallest tables."""

import os

import pytest
from oracle import connect, same

from tallyloom.queries import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    same(QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLE[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
