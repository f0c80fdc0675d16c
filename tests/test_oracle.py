"""Every registered query against its independent SQL."""

import pytest

from checks.compare import compare, connect
from checks.duckdb_sql import ORACLES
from checks.spark_queries import QUERIES
from checks.tables import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, note = compare(spark, con, SMALL, QUERIES[name], ORACLES[name])
    assert ok, note
    assert "TYPES" not in note, note


def test_entry_runs(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() == 1335
