"""Comparison of a Spark result with the same query in DuckDB, rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(data_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(data_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


# How DuckDB calls the Spark types in use.
_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(connection, sql: str, df) -> list[str]:
    result = connection.execute(sql)
    names = sorted(column[0] for column in result.description)
    found = []
    if names != sorted(df.columns):
        return [f"columns {names} in SQL, {sorted(df.columns)} in Spark"]
    types = {c[0]: str(c[1]) for c in result.description}
    for name, kind in df.dtypes:
        if types[name] != _TYPES.get(kind, kind):
            found.append(f"type of {name}: {types[name]} in SQL, {kind} in Spark")
    order = [c[0] for c in result.description]
    expected = Counter(tuple(map(repr, row)) for row in result.fetchall())
    actual = Counter(tuple(map(repr, row)) for row in df.select(*order).collect())
    if expected != actual:
        missing, extra = expected - actual, actual - expected
        found.append(f"{sum(expected.values())} rows in SQL, {sum(actual.values())} in Spark")
        found.append(f"only in SQL: {list(missing)[:3]}, only in Spark: {list(extra)[:3]}")
    return found
