"""Spark-vs-DuckDB parity check, shaped like the driver's correctness gate.

Usage: python tests/parity.py [sf_dir] [name ...]
Compares row count, column names and order-insensitive values. Floats are
compared exactly and, failing that, at 1e-9 relative tolerance (reported
separately, because an exact hash would still differ).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, approx: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") if approx else v
    if isinstance(v, decimal.Decimal):
        return float(v) if approx else str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, approx) for x in v)
    return v


def rows_key(rows, approx):
    return sorted((tuple(_norm(x, approx) for x in r) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    status = []
    if sorted(s_cols) != sorted(d_cols):
        status.append(f"COLUMNS spark={s_cols} duck={d_cols}")
    else:
        order = [d_cols.index(c) for c in s_cols]
        d_rows = [tuple(r[i] for i in order) for r in d_rows]
    if len(s_rows) != len(d_rows):
        status.append(f"ROWS spark={len(s_rows)} duck={len(d_rows)}")
    elif not status:
        if rows_key(s_rows, False) != rows_key(d_rows, False):
            if rows_key(s_rows, True) == rows_key(d_rows, True):
                status.append("APPROX-ONLY")
            else:
                a, b = rows_key(s_rows, True), rows_key(d_rows, True)
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                status.append(f"VALUES first diffs: {diff}")
    return status or ["OK"], len(s_rows), t1 - t0, t2 - t1


def main():
    from __spark_entry__ import oracle_sql, queries
    from tessera.session import get_spark
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            n = q(spark, sf_dir).count()
            print(f"{name:32s} NO-ORACLE rows={n}")
            continue
        try:
            status, n, ts, td = compare(spark, con, name, q, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            status, n, ts, td = [f"ERROR {type(e).__name__}: {str(e)[:400]}"], -1, 0, 0
        if status != ["OK"]:
            bad += 1
        print(f"{name:32s} {' | '.join(status)}  rows={n} spark={ts:.1f}s duck={td:.1f}s", flush=True)
    print("MISMATCHES", bad)


if __name__ == "__main__":
    main()
