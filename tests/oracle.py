"""Rows of a query and of its SQL in DuckDB, made comparable."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, list | tuple):
        return [cell(x) for x in v]
    return str(v) if isinstance(v, datetime.date | datetime.datetime) else v


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(repr([cell(r[c]) for c in columns]) for r in df.collect())


def duck_rows(connection, sql):
    r = connection.execute(sql)
    names = [d[0] for d in r.description]
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    return columns, sorted(repr([cell(row[k]) for k in at]) for row in r.fetchall())
