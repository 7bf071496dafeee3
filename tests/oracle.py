"""Runs a query and its SQL twin over the same files and compares the rows."""

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def normal(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in at]
    return names, sorted((tuple(plain(row[i]) for i in at) for row in rows), key=repr)


def spark_rows(df):
    return normal(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return normal(columns, cursor.fetchall())
