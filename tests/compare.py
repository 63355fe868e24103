"""Spark rows against DuckDB rows, as multisets of values with columns in order of name."""

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, list | tuple):
        return tuple(map(_value, v))
    return str(v)


def connect(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c


def rows_of(df):
    columns = sorted(df.columns)
    return columns, Counter(tuple(_value(r[c]) for c in columns) for r in df.collect())


def oracle_rows(connection, sql):
    r = connection.execute(sql)
    names = [d[0] for d in r.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(_value(x[i]) for i in order) for x in r.fetchall())
