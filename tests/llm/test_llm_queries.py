"""The numbered queries that SQL can express, against their SQL."""

from __future__ import annotations

import pytest
from compare import difference, duckdb_views

from fleetlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_matches_sql(spark, name):
    assert difference(spark, duckdb_views(SF), QUERIES[name], SF) is None
