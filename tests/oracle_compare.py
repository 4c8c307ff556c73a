"""Run every registered question in Spark and its oracle SQL in DuckDB; compare.

Usage: python -m tests.oracle_compare [sf_dir] [key ...]
Compares column names, column types, row counts and an order-insensitive hash of the
values (columns sorted by name), like the driver's correctness gate.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def spark_type(dt) -> str:
    name = dt.simpleString()
    return {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT",
            "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}.get(
        name, name.upper())


def norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (_dt.date, _dt.datetime)):
        return v.isoformat()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, sf_dir: str, keys=None, verbose=True, model=None):
    """Compare Spark and DuckDB per key. ``model`` (optional) runs the questions on a
    given RetailModel instead of the registry's default one."""
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from tillroll.plans.registry import QUESTIONS
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for key in keys or list(qs):
        t0 = time.time()
        df = QUESTIONS[key](model) if model is not None else qs[key](spark, sf_dir)
        s_cols = df.columns
        s_types = [spark_type(f.dataType) for f in df.schema.fields]
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if key not in sqls:
            results[key] = dict(ok=None, rows=len(s_rows))
            continue
        cur = con.execute(sqls[key])
        d_cols = [c[0] for c in cur.description]
        d_types = [str(c[1]) for c in cur.description]
        d_rows = cur.fetchall()
        problems = []
        if sorted(s_cols) != sorted(d_cols):
            problems.append(f"columns spark={s_cols} duck={d_cols}")
        else:
            st = dict(zip(s_cols, s_types))
            dt = dict(zip(d_cols, d_types))
            bad = {c: (st[c], dt[c]) for c in s_cols if st[c] != dt[c]}
            if bad:
                problems.append(f"types {bad}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        if not problems or all(not p.startswith("columns") for p in problems):
            hs, ls = digest(s_cols, s_rows)
            hd, ld = digest(d_cols, d_rows)
            if hs != hd:
                only_s = sorted(set(ls) - set(ld))[:3]
                only_d = sorted(set(ld) - set(ls))[:3]
                problems.append(f"values differ; spark-only {only_s} duck-only {only_d}")
        results[key] = dict(ok=not problems, rows=len(s_rows), problems=problems, sec=round(t1 - t0, 2))
        if verbose:
            print(f"{key:16s} {'OK ' if not problems else 'BAD'} rows={len(s_rows):6d} "
                  f"{t1 - t0:6.2f}s {'; '.join(problems)[:600]}", flush=True)
    return results


if __name__ == "__main__":
    from tillroll.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v["ok"] is False]
    print("BAD:", bad)
