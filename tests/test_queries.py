"""Every registered query against its SQL statement on the smallest given tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry
from gristmill.queries import all_queries as queries
from gristmill.queries import all_sql as oracle_sql
from oracle import compare, connect

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no given tables")


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    assert compare(spark, con, DATA, queries()[name], oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry(spark).count() > 0
