"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import difference, duckdb_views

import __spark_entry__ as entry
from fleetlake.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duckdb_views(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert difference(spark, connection, QUERIES[name], SF) is None


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
