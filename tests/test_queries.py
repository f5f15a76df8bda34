"""Every registered query against its SQL."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from probelake.verification.oracles import ORACLES
from probelake.verification.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, tables, name):
    assert compare(spark, tables, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
