"""Side-by-side run of a query and its SQL, as the driver does it."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duckdb_views(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def canonical(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, connection, query, sf: str) -> str | None:
    """What differs, or None."""
    df = query.run(spark, sf)
    columns, rows = canonical(df.columns, [tuple(row) for row in df.collect()])
    result = connection.execute(query.sql)
    sql_columns, sql_rows = canonical([d[0] for d in result.description], result.fetchall())
    if columns != sql_columns:
        return f"columns {columns} and {sql_columns}"
    if len(rows) != len(sql_rows):
        return f"{len(rows)} and {len(sql_rows)} rows"
    unlike = [(a, b) for a, b in zip(rows, sql_rows) if a != b]
    return f"{len(unlike)} of {len(rows)} rows, such as {unlike[0]}" if unlike else None
