"""Rows of a query and of its DuckDB oracle in comparable form."""

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(data: str):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    names = sorted(df.columns)
    return names, ordered(tuple(plain(r[n]) for n in names) for r in df.collect())


def duck_rows(c, sql):
    rel = c.sql(sql)
    at = {n: k for k, n in enumerate(rel.columns)}
    names = sorted(at)
    return names, ordered(tuple(plain(r[at[n]]) for n in names) for r in rel.fetchall())
