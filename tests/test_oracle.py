"""Every registered query with SQL gives the rows DuckDB gives for that SQL, on the smallest data."""

import pytest

import check
from learnlake.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.duck(FOLDER)


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, message, _ = check.compare(spark, con, FOLDER, name)
    assert ok, message
