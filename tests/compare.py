"""Row-by-row comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

SMALL = "/root/testdata/sf0.001"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"
}


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(v := _plain(row[i])).__name__, v) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    """None when both have the same columns, types and rows."""
    described = connection.execute("DESCRIBE " + sql).fetchall()
    names = [row[0] for row in described]
    types = sorted((row[0], SPARK_TYPES.get(row[1], row[1])) for row in described)
    if types != sorted(spark_df.dtypes):
        return f"columns {sorted(spark_df.dtypes)} instead of {types}"
    expected = rows_of(names, connection.execute(sql).fetchall())
    found = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if found != expected:
        extra = list((found - expected).items())[:2]
        missing = list((expected - found).items())[:2]
        return (
            f"{sum(found.values())} rows instead of {sum(expected.values())}; "
            f"extra {extra}; missing {missing}"
        )
    return None
