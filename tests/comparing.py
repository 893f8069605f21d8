"""Compare a registered query with its SQL twin."""

from __future__ import annotations

import math
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, folder: str, function, sql: str) -> dict:
    """Row, column and value agreement, and the first rows that differ."""
    started = time.time()
    df = function(spark, folder)
    ours = _sorted_rows(df.columns, df.collect())
    seconds = time.time() - started
    with connect(folder) as connection:
        cursor = connection.execute(sql)
        names = [d[0] for d in cursor.description]
        theirs = _sorted_rows(names, cursor.fetchall())
    different = [(a, b) for a, b in zip(ours, theirs) if a != b][:3]
    return {
        "columns": sorted(df.columns) == sorted(names),
        "rows": (len(ours), len(theirs)),
        "same": ours == theirs and sorted(df.columns) == sorted(names),
        "different": different,
        "types": [f.dataType.simpleString() for f in df.schema.fields],
        "seconds": round(seconds, 2),
    }
