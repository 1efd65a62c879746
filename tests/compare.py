"""Side-by-side comparison of a Spark result with DuckDB SQL."""

from __future__ import annotations

from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = ("part", "customer", "nation", "events")


def connect(sample_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sample_dir}/{table}.parquet'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, Decimal):
        return value.normalize()
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df: DataFrame) -> tuple[list[str], Counter]:
    return sorted(df.columns), _bag(df.columns, [tuple(row) for row in df.collect()])


def duck_bag(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    return sorted(columns), _bag(columns, cursor.fetchall())
