"""Side-by-side check of the registered queries against DuckDB.

    python tests/oracle.py [sf_dir] [name-part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v).__name__) if v is None else "", v if v is not None else 0) for v in row)


def _plain(v):
    if isinstance(v, float) and v == int(v) if isinstance(v, float) and math.isfinite(v) else False:
        return int(v)
    return v


def compare(spark_df, con, sql: str) -> str | None:
    """None when columns, rows and values agree exactly, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    cols = sorted(spark_df.columns)
    if cols != sorted(names):
        return f"columns {cols} != {sorted(names)}"
    got = [tuple(r[c] for c in cols) for r in spark_df.collect()]
    at = [names.index(c) for c in cols]
    want = [tuple(r[i] for i in at) for r in want]
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    order = lambda r: tuple(str(_plain(v)) for v in r)
    got, want = sorted(got, key=order), sorted(want, key=order)
    for g, w in zip(got, want):
        if tuple(map(_plain, g)) != tuple(map(_plain, w)):
            return f"{dict(zip(cols, g))} != {dict(zip(cols, w))}"
    types = [(c, type(g).__name__, type(w).__name__) for c, g, w in zip(cols, *(r[0] for r in (got, want)))] if got else []
    odd = [t for t in types if t[1] != t[2] and "NoneType" not in t]
    return f"types {odd}" if odd else None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    from tests.conftest import session

    import __spark_entry__ as entry

    spark, con = session(), connect(sf_dir)
    sqls, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            error = compare(df, con, sqls[name]) if name in sqls else (None if df.count() else "no rows")
        except Exception as e:  # noqa: BLE001
            error = f"{type(e).__name__}: {str(e)[:600]}"
        bad += error is not None
        print(f"{'ok  ' if error is None else 'FAIL'} {name} {time.time() - start:.1f}s {error or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
