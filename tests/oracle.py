"""Run a query and its SQL on the same files and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys

import duckdb

sys.path.insert(0, __file__.rsplit("/", 2)[0])

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(df, sql, con):
    """None when equal, else a short description of the difference."""
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want_cols != got_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}; got {got[:2]} want {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} rows differ; first {str(bad[0][0])[:600]} != {str(bad[0][1])[:600]}"
    types = {type(v) for r in got[:50] for v in r}
    if types & {list, dict}:
        return "nested values in the result"
    return None
