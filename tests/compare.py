"""Run a registered query in Spark and its SQL in DuckDB, and compare."""

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value))
    if isinstance(value, Decimal):
        return str(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(_plain(row[i]) for i in order)) for row in rows)


def difference(spark, connection, query, sql, sf_dir):
    """'' when both agree, else a short account."""
    df = query(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    left, right = _rows(df.columns, spark_rows), _rows(names, sql_rows)
    if left == right:
        return "" if left else "no rows"
    only_left = [r for r in left if r not in set(right)][:2]
    only_right = [r for r in right if r not in set(left)][:2]
    return f"{len(left)} vs {len(right)} rows; spark {str(only_left)[:600]}; sql {str(only_right)[:600]}"
