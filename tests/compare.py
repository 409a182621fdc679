"""Run a query and its SQL side by side and describe the first difference."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return value.normalize()
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same bag of rows under the same column names."""
    table = df.toArrow()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(table.column_names) != sorted(names):
        return f"columns differ: {set(table.column_names) ^ set(names)}"
    ours = rows_of(table.column_names, zip(*[c.to_pylist() for c in table.columns]))
    theirs = rows_of(names, result.fetchall())
    if not sum(ours.values()):
        return "no rows"
    if ours == theirs:
        return None
    a, b = sorted((ours - theirs).items(), key=repr), sorted((theirs - ours).items(), key=repr)
    cols = sorted(names)
    hint = ""
    if a and b:
        hint = str([(c, x, y) for c, x, y in zip(cols, a[0][0], b[0][0]) if x != y][:6])
    return f"{sum(ours.values())} vs {sum(theirs.values())} rows, {len(a)}/{len(b)} differ; first: {hint}"
