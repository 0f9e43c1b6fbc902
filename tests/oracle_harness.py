"""Run a registered query in Spark and its oracle in DuckDB and compare
row count, column names and order-insensitive values (like the driver)."""

from __future__ import annotations

import math

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    return v


def _rows(records, cols):
    return sorted(
        (tuple(_norm(r[c]) for c in cols) for r in records),
        key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t),
    )


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s_rows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    s_cols = sorted(sdf.columns)
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = E.oracle_sql().get(name)
    if sql is None:
        out["oracle"] = "none"
        return out
    res = con.execute(sql)
    d_cols_raw = [d[0] for d in res.description]
    d_rows = [dict(zip(d_cols_raw, r)) for r in res.fetchall()]
    d_cols = sorted(d_cols_raw)
    out["oracle_rows"] = len(d_rows)
    out["cols_match"] = s_cols == d_cols
    if s_cols != d_cols:
        out["cols"] = (s_cols, d_cols)
        out["match"] = False
        return out
    a, b = _rows(s_rows, s_cols), _rows(d_rows, s_cols)
    out["match"] = a == b
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diffs
        out["cols_order"] = s_cols
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from kassa.session import get_session
    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(E.queries())
    spark = get_session()
    import os

    if os.environ.get("SESSION_TZ"):  # results must not depend on the session zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "error": repr(exc)[:800]}
        ok = r.get("match", r.get("oracle") == "none")
        bad += not ok
        print(("OK  " if ok else "FAIL"), r, flush=True)
    print("failures:", bad)
