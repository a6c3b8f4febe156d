"""Comparison of a query's rows with those of its SQL, as multisets."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return v


def same(spark, sf_dir, query, sql) -> tuple[Counter, Counter]:
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    c = database(sf_dir).execute(sql)
    names = [d[0] for d in c.description]
    assert sorted(names) == columns
    at = [names.index(x) for x in columns]
    want = Counter(tuple(plain(r[i]) for i in at) for r in c.fetchall())
    return Counter(tuple(map(plain, r)) for r in df.select(*columns).collect()), want
