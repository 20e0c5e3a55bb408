"""Every registered query against its SQL, on the smallest given tables."""

import pytest

import __spark_entry__ as entry
from chainlake.registry import checks

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return checks.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    ok, message = checks.compare(spark, con, FOLDER, QUERIES[name], ORACLES.get(name))
    assert ok, message


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
