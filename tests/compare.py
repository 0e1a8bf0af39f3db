"""Comparison of query results with the SQL oracle, independent of row order."""

from __future__ import annotations

import os

import duckdb

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

# Spark types and the DuckDB types that carry the same values.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in GIVEN:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(df, connection, sql: str) -> str | None:
    """What differs between a Spark result and a statement, or None."""
    cursor = connection.execute(sql)
    described = {column[0]: str(column[1]) for column in cursor.description}
    expected_rows = cursor.fetchall()
    spark_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if sorted(spark_types) != sorted(described):
        return f"columns {sorted(spark_types)} != {sorted(described)}"
    wrong = {n: (spark_types[n], described[n]) for n in described if spark_types[n] != described[n]}
    if wrong:
        return f"types {wrong}"
    columns = sorted(described)
    order = [list(described).index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in expected_rows), key=repr)
    actual = sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{a} != {e}"
    return None

