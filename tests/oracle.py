"""Compare a registered query with its DuckDB oracle, order-insensitively."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") + 0.0
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((x is not None, str(type(x)), str(x)) for x in r))


def compare(spark, con, q, folder) -> str | None:
    """None when equal, else a short description of the difference."""
    df = q(spark, folder)
    names = df.columns
    got = rows(names, [tuple(r) for r in df.collect()])
    cur = con.execute(q.sql)
    want_names = [d[0] for d in cur.description]
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}"
    want = rows(want_names, cur.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, oracle {len(want)}; first got {got[:2]} want {want[:2]}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {sorted(names)} got {bad[0][0]} want {bad[0][1]}"
    if not got:
        return "EMPTY (equal but no rows)"
    return None
