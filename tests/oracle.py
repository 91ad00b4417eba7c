"""Compare a query with its SQL in DuckDB: columns by name, rows in any order, doubles to 2e-9 (sums in another order)."""

import datetime as dt
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def differences(frame, con, sql, limit=5):
    """[] if equal, else some of what differs."""
    names = sorted(frame.columns)
    got = [tuple(_plain(r[n]) for n in names) for r in frame.collect()]
    rel = con.execute(sql)
    have = [d[0] for d in rel.description]
    if sorted(have) != names:
        return [f"columns {names} and {sorted(have)}"]
    at = [have.index(n) for n in names]
    want = [tuple(_plain(r[i]) for i in at) for r in rel.fetchall()]
    key = lambda r: tuple((v is not None, str(type(v)) if not isinstance(v, (int, float)) else "", v if v is not None else 0) for v in r)
    if len(got) != len(want):
        return [f"{len(got)} rows and {len(want)}"]
    close = lambda a, b: a == b or isinstance(a, float) and isinstance(b, (int, float)) and math.isclose(a, b, rel_tol=1e-12, abs_tol=2e-9)
    return [(names, a, b) for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True) if not all(map(close, a, b))][:limit]
