"""Compares registered queries with their SQL twins, value by value."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_normal(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((value is None, str(value)) for value in row),
    )


def spark_result(df):
    return sorted(df.columns), _rows(df.columns, [tuple(row) for row in df.collect()])


def duckdb_result(connection, sql):
    cursor = connection.execute(sql)
    columns = [item[0] for item in cursor.description]
    return sorted(columns), _rows(columns, cursor.fetchall())


def difference(spark_side, duckdb_side) -> str | None:
    """None when equal, else a short description of the first difference."""
    if spark_side[0] != duckdb_side[0]:
        return f"columns {set(spark_side[0]) ^ set(duckdb_side[0])}"
    if len(spark_side[1]) != len(duckdb_side[1]):
        return f"rows {len(spark_side[1])} != {len(duckdb_side[1])}"
    for a, b in zip(spark_side[1], duckdb_side[1]):
        if a != b:
            pairs = [(n, x, y) for n, x, y in zip(spark_side[0], a, b) if x != y]
            return f"values {pairs[:4]}"
    return None
