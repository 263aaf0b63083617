"""Every query with a SQL twin gives the same rows in DuckDB."""

import pytest
from oracle import compare, connect

from queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, con, name):
    same, message = compare(QUERIES[name](spark, folder), con, ORACLES[name])
    assert same, message


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
