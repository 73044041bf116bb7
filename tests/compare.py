"""Run a query and its SQL on one set of tables and compare the rows."""

import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connection(sf_dir):
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for f in os.listdir(sf_dir):
        path = os.path.join(sf_dir, f)
        c.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{path}'")
    return c


def plain(v):
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in data)


def same(df, con, sql):
    relation = con.sql(sql)
    got, expected = rows(df.columns, map(tuple, df.collect())), rows(relation.columns, relation.fetchall())
    assert got[0] == expected[0]
    assert got[1] == expected[1], (list((got[1] - expected[1]).items())[:3], list((expected[1] - got[1]).items())[:3])
