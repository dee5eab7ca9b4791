"""Every query with SQL gives the rows of that SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql
from check import compare, duck
from ledgersift.checks.oracle import ORACLE
from ledgersift.checks.queries import QUERIES

WITH_SQL = list(ORACLE)


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def test_every_query_is_checked_by_sql():
    assert set(QUERIES) == set(WITH_SQL)


@pytest.mark.parametrize("key", WITH_SQL)
def test_same_rows(spark, con, folder, key):
    verdict, _ = compare(spark, con, key, folder, oracle_sql()[key])
    assert verdict == "same"


def test_entry(spark):
    assert entry(spark).count() == 2
