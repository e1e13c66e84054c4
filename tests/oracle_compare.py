"""Side-by-side check of every report against its DuckDB oracle.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``.  For each
report: run the Spark DataFrame, run the oracle SQL on the same Parquet
tables, then compare column names, row counts and the multiset of rows
(columns sorted by name, values normalised: timestamps to ISO text, floats
exact).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return cols, sorted(out, key=_key)


def compare(spark, sf_dir: str, names=None, con=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = con or duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            s_cols, s_rows = canon(sdf.columns, [tuple(r) for r in sdf.collect()])
        except Exception as exc:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", repr(exc)[:400])
            if verbose:
                print(f"{name:32s} SPARK_ERROR {repr(exc)[:400]}")
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = ("ROWS_ONLY", len(s_rows))
            if verbose:
                print(f"{name:32s} rows-only {len(s_rows)} rows  spark {t1 - t0:.2f}s")
            continue
        try:
            rel = con.execute(sqls[name])
            d_cols = [d[0] for d in rel.description]
            d_cols, d_rows = canon(d_cols, rel.fetchall())
        except Exception as exc:  # noqa: BLE001
            results[name] = ("ORACLE_ERROR", repr(exc)[:400])
            if verbose:
                print(f"{name:32s} ORACLE_ERROR {repr(exc)[:400]}")
            continue
        if s_cols != d_cols:
            status = ("COLUMNS", s_cols, d_cols)
        elif len(s_rows) != len(d_rows):
            status = ("ROWCOUNT", len(s_rows), len(d_rows))
        elif s_rows != d_rows:
            diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
            status = ("VALUES", diff)
        else:
            status = ("OK", len(s_rows))
        results[name] = status
        if verbose:
            print(f"{name:32s} {status[0]} {status[1:] if status[0] != 'OK' else status[1]}"
                  f"  spark {t1 - t0:.2f}s")
    return results


if __name__ == "__main__":
    from urbanpulse.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; failing: {sorted(bad)}")
