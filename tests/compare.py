"""Comparing Spark results with DuckDB's, whatever the order of rows and columns."""

import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(data):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def norm(v):
    if v is None or isinstance(v, float) and v != v:
        return None
    if isinstance(v, decimal.Decimal):
        return str(v.normalize() if v else 0)
    if isinstance(v, float):
        return round(v, 6)
    return str(v)


def spark_rows(df):
    order = sorted(df.columns)
    return order, sorted(repr([norm(r[c]) for c in order]) for r in df.collect())


def duck_rows(con, sql):
    rel = con.sql(sql)
    order = sorted(rel.columns)
    at = [rel.columns.index(c) for c in order]
    return order, sorted(repr([norm(r[i]) for i in at]) for r in rel.fetchall())
