"""Comparing a Spark result with DuckDB's for the same tables."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c


def value(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "~"
    return repr(x) if isinstance(x, float) else str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(value(r[i]) for i in order) for r in data)


def same(df, sql, con):
    other = con.sql(sql)
    assert sorted(df.columns) == sorted(other.columns)
    assert rows(df.columns, df.collect()) == rows(other.columns, other.fetchall())
