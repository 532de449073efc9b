"""Runs a query in Spark and its SQL in DuckDB and compares all rows."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    db = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        db.sql(f"create view {t} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return db


def text(value):
    if value is None or value is pd.NaT or isinstance(value, float) and value != value:
        return ""
    if isinstance(value, float):
        return str(int(value)) if value == int(value) else f"{value:.6g}"
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(row[i]) for i in order) for row in data)


def assert_same(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    want = connect(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())
