"""Run queries on Spark and their oracle SQL on DuckDB and compare all values."""

from __future__ import annotations

import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted_rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((value is not None, str(value)) for value in row),
    )


def compare(spark, con, sf_dir: str, query, sql: str | None) -> tuple[str, float]:
    """'ok', 'rows n' without an oracle, or what differs; and Spark's seconds."""
    start = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    seconds = time.time() - start
    if sql is None:
        return f"rows {len(got)}", seconds
    result = con.execute(sql)
    expected_columns = [column[0] for column in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}", seconds
    a = _sorted_rows(df.columns, [tuple(row) for row in got])
    b = _sorted_rows(expected_columns, expected)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}", seconds
    for left, right in zip(a, b, strict=True):
        if left != right:
            return f"{sorted(df.columns)}: {left} != {right}", seconds
    return ("ok" if a else "ok, but empty"), seconds
