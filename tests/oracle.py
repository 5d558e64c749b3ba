"""Compares a registered query with its SQL, row for row, in any order."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return float(f"{value:.12g}") + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat(timespec="microseconds")
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def duck_rows(connection, sql):
    result = connection.sql(sql)
    return rows_of(result.columns, result.fetchall())
