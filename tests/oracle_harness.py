"""Spark-vs-DuckDB comparison used by the tests and by hand.

Mirrors the correctness gate: same column names, same row count, and the
same multiset of rows (columns sorted by name, order-insensitive).  Doubles
are compared exactly unless ``float_digits`` is given.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import sys
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, float_digits):
    if isinstance(v, float):
        if v != v:
            return "nan"
        return round(v, float_digits) if float_digits is not None else repr(v)  # repr keeps -0.0 apart
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows, float_digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], float_digits) for i in order) for r in rows)


def compare(spark, con, name, spark_fn, sql, sf_dir, float_digits=None):
    sdf = spark_fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = "COLUMNS"
        out["detail"] = f"spark-only {sorted(set(s_cols) - set(d_cols))} oracle-only {sorted(set(d_cols) - set(s_cols))}"
        return out
    a, b = _rows(s_cols, s_rows, float_digits), _rows(d_cols, d_rows, float_digits)
    if a == b:
        out["status"] = "MATCH"
    else:
        out["status"] = "VALUES"
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        out["detail"] = f"cols={sorted(s_cols)} spark-only={only_s} oracle-only={only_d}"
    return out


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from ledgerlens.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    only = [a for a in argv if not a.startswith("/")]
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if only and k not in only:
            continue
        if k not in sqls:
            print(f"NO-ORACLE {k}")
            continue
        try:
            r = compare(spark, con, k, fn, sqls[k], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": k, "status": "ERROR", "detail": f"{type(e).__name__}: {str(e)[:600]}"}
        bad += r["status"] != "MATCH"
        print(f"{r['status']:8s} {k:28s} {r.get('spark_rows', '')}/{r.get('oracle_rows', '')} {r.get('detail', '')}",
              flush=True)
    print(f"mismatches: {bad}")


if __name__ == "__main__":
    main(sys.argv[1:])
