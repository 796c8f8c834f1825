"""Compare a query with its DuckDB SQL, the way the driver does: columns by name, rows in any order."""

import datetime
import decimal
import math
import os

import duckdb

DATA = "/root/testdata"


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return float(f"{v:.12g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, bytearray):
        return bytes(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def connect(folder):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in os.listdir(folder):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    return c


def compare(spark, query, sql, size):
    folder = f"{DATA}/{size}"
    df = query(spark, folder)
    names = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())
    cursor = connect(folder).execute(sql)
    have = [x[0] for x in cursor.description]
    assert sorted(have) == names
    at = [have.index(n) for n in names]
    want = sorted(repr(tuple(plain(r[k]) for k in at)) for r in cursor.fetchall())
    assert len(got) == len(want)
    assert got == want
