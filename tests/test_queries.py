"""Every registered query against its SQL on the smallest tables, and the entry point."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import check, connection

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables absent")


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    _, rows, problem, _ = check(spark, con, name, FOLDER, queries(), oracle_sql())
    assert problem is None, problem
    assert rows > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_sql_only_for_registered_queries():
    assert set(oracle_sql()) <= set(queries())
