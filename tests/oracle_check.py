"""Run every registered query on Spark and its oracle SQL on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]

Compares row count, column names (sorted) and the multiset of rows, with
doubles compared after rounding to 9 significant digits.
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from surveyframe.session import get_spark  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v) if EXACT else float(f"{float(v):.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if not hasattr(v, "hour") else v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, qs, orc, sf):
    """-> (status, message) for one query."""
    df = qs[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    if name not in orc:
        return "NO-ORACLE", f"rows={len(srows)}"
    cur = con.execute(orc[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        a, b = canon(scols, srows), canon(dcols, drows)
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        if diffs:
            problems.append(f"{len(diffs)} differing rows, e.g. spark={diffs[0][0]} duck={diffs[0][1]}")
    if os.environ.get("ORACLE_ARROW") == "1":
        st = {f.name: str(f.type) for f in df.toArrow().schema}
        dt = {f.name: str(f.type) for f in con.execute(orc[name]).to_arrow_table().schema}
        if st != dt:
            diff = {k: (st.get(k), dt.get(k)) for k in set(st) | set(dt) if st.get(k) != dt.get(k)}
            problems.append(f"arrow types differ {diff}")
    return ("OK" if not problems else "MISMATCH"), "; ".join(problems)


def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            status, msg = compare(spark, con, name, qs, orc, sf)
        except Exception as e:  # noqa: BLE001
            status, msg = "FAIL", str(e)[:600]
        bad += status not in ("OK", "NO-ORACLE")
        print(f"{status} {name} {time.time() - t0:.2f}s {msg[:1500]}")
    print(f"done, {bad} problems")


if __name__ == "__main__":
    main()
