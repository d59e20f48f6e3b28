"""Comparing a Spark result with the rows of its check statement."""

from __future__ import annotations

import duckdb

from testbed.checks import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(columns, rows):
    """Column names in order and the sorted rows with columns in that order, every value as text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted(tuple(repr(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], body


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())
