"""Compare registered queries with their SQL, as sets of rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        if isinstance(value, float) and math.isnan(value):
            return (0, "")
        return (2, f"{float(value):.6f}")
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str:
    """Empty when columns and rows agree; otherwise a short account."""
    cursor = connection.execute(sql)
    sql_columns = [c[0] for c in cursor.description]
    expected = rows_of(sql_columns, cursor.fetchall())
    if sorted(sql_columns) != sorted(spark_df.columns):
        return f"columns: {sorted(spark_df.columns)} != {sorted(sql_columns)}"
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(actual) != len(expected):
        return f"rows: {len(actual)} != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"first difference: {a} != {e}"
    return ""
