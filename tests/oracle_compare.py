"""Run a registered Spark query and its DuckDB oracle; compare results.

Rows are compared as multisets after sorting columns by name, the way the
driver's correctness gate does, or in the order they come. Doubles are
compared after rounding to 9 significant digits and exactly, both reported.
"""

from __future__ import annotations

import datetime as dt
import math
import sys

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is None:
            return v
        return float(f"{v:.{digits}g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def _rows(cols, rows, digits, ordered=False):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return out if ordered else sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, name: str, sf_dir: str, con=None, ordered: bool = False) -> dict:
    import __spark_entry__ as E

    df = E.queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(s_rows)}
    if sql is None:
        res["oracle"] = False
        return res
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res.update(oracle=True, duck_rows=len(d_rows),
               cols_match=sorted(s_cols) == sorted(d_cols))
    if not res["cols_match"]:
        res["spark_cols"], res["duck_cols"] = s_cols, d_cols
        res["match"] = False
        return res
    a, b = _rows(s_cols, s_rows, 9, ordered), _rows(d_cols, d_rows, 9, ordered)
    res["match"] = a == b
    res["exact"] = _rows(s_cols, s_rows, None) == _rows(d_cols, d_rows, None)
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:3]
        res["only_duck"] = list(sb - sa)[:3]
    return res


if __name__ == "__main__":
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pluvio.session import build_session
    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    spark = build_session()
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:400]}
        ok = r.get("match", not r.get("oracle", True)) and "error" not in r
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
