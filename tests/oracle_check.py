"""Run every registered query next to its DuckDB oracle and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison: column names sorted, row counts, then the multiset of rows
(floats rounded to 9 places, values as text).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tillroll.session import local_session  # noqa: E402
from tillroll.sources.fixtures import TABLES  # noqa: E402


EXACT = os.environ.get("ORACLE_EXACT") == "1"
# Registered queries emit flat scalar columns only, so values hash the same in any engine.
FLAT_TYPES = {"string", "int", "bigint", "double", "boolean", "timestamp", "timestamp_ntz", "date"}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT else f"{round(v, 9):.9f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return "None" if v is None else str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records), [cols[i] for i in order]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    nested = [f.name for f in df.schema.fields if f.dataType.simpleString() not in FLAT_TYPES]
    if nested:
        return f"{name:28s} BAD nested output columns {nested}"
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    s, scols = rows_of(df.columns, srows)
    if sql is None:
        return f"{name:28s} rows-only n={len(s)} spark={t1 - t0:.1f}s"
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    d, dcols = rows_of(dcols, cur.fetchall())
    t2 = time.time()
    ok = scols == dcols and s == d
    msg = f"{name:28s} {'OK ' if ok else 'BAD'} n={len(s)}/{len(d)} spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s"
    if not ok:
        if scols != dcols:
            msg += f"\n   cols spark={scols}\n   cols duck ={dcols}"
        ss, dd = set(s), set(d)
        msg += f"\n   only spark: {sorted(ss - dd)[:3]}\n   only duck : {sorted(dd - ss)[:3]}"
    return msg


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            msg = check(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # report and continue
            msg = f"{name:28s} ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += ("BAD" in msg) or ("ERROR" in msg)
        print(msg, flush=True)
    print("mismatches:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
