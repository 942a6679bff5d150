"""Spark result against DuckDB on the same parquet tables, order ignored."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return int(value) if value == int(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if hasattr(value, "as_integer_ratio") and not isinstance(value, int):
        return _plain(float(value))
    return value


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(table, key=repr)


def differences(df, con, sql: str, limit: int = 3) -> str | None:
    spark_columns, spark_rows = normalised(df.columns, [tuple(r) for r in df.collect()])
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    duck_columns, duck_rows = normalised(names, relation.fetchall())
    if spark_columns != duck_columns:
        return f"columns {spark_columns} != {duck_columns}"
    if spark_rows == duck_rows:
        return None
    left = set(map(repr, spark_rows))
    right = set(map(repr, duck_rows))
    only_spark = sorted(left - right)[:limit]
    only_duck = sorted(right - left)[:limit]
    return (
        f"rows {len(spark_rows)} vs {len(duck_rows)}; differing {len(left - right)}; "
        f"spark {only_spark}; duckdb {only_duck}"
    )
