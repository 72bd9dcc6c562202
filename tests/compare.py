"""Row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def differences(df, connection, sql: str) -> list[str]:
    """Nothing when names, types and rows agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    expected = _rows(names, result.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    if dict(df.dtypes) != types:
        problems.append(f"types {dict(df.dtypes)} against {types}")
    found = _rows(df.columns, df.collect())
    if found != expected:
        extra, missing = found - expected, expected - found
        problems.append(
            f"{sum(found.values())} rows against {sum(expected.values())}; "
            f"extra {list(extra)[:3]}; missing {list(missing)[:3]}"
        )
    return problems
