"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from compare import connect, difference

from tallyweave.catalogue import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection, SQL[name]) is None
