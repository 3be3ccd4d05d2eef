"""Compare Spark ``queries()`` against DuckDB ``oracle_sql()`` on the driver tables.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: rows, column names and an order-insensitive value comparison.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v) if abs(v) < 2**53 else v
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN"}


def type_diffs(sdf, con, sql):
    """Columns whose Spark type does not map to the DuckDB oracle's type."""
    d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for f in sdf.schema.fields:
        t = f.dataType.simpleString()
        if d.get(f.name) != SPARK_TO_DUCK.get(t, t.upper()):
            out.append(f"{f.name}: {t} vs {d.get(f.name)}")
    return out


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from gamelake.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, ors = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or sorted(qs)):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} SPARK ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in ors:
            print(f"{k:32s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(ors[k])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} DUCK ERROR {str(e)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        tdiff = type_diffs(sdf, con, ors[k]) if ok_cols else []
        ok_rows = len(srows) == len(drows)
        ok_vals = ok_cols and canon(scols, srows) == canon(dcols, drows)
        status = "OK" if (ok_cols and ok_rows and ok_vals) else "MISMATCH"
        bad += status != "OK"
        print(f"{k:32s} {status:8s} rows={len(srows)}/{len(drows)} cols={'ok' if ok_cols else 'DIFF'} "
              f"vals={'ok' if ok_vals else 'DIFF'} types={'ok' if not tdiff else 'DIFF'} {ts:.1f}s")
        if tdiff:
            print("   types:", tdiff)
        if not ok_cols:
            print("   spark:", sorted(scols), "\n   duck: ", sorted(dcols))
        elif not ok_vals:
            a, b = canon(scols, srows), canon(dcols, drows)
            sa, sb = set(a), set(b)
            print("   cols:", sorted(scols))
            print("   spark-only:", list(sa - sb)[:3])
            print("   duck-only: ", list(sb - sa)[:3])
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
