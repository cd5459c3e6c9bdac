"""Spark query vs DuckDB oracle comparison (row count, columns, types, values)."""

from __future__ import annotations

import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                  "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "smallint": "SMALLINT",
                  "tinyint": "TINYINT"}


def duck(base: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(base, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, name: str, fn, sql: str, base: str, con=None) -> dict:
    con = con or duck(base)
    sdf = fn(spark, base)
    s_cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [tuple(_norm(x) for x in r) for r in res.fetchall()]
    d_types = [str(t) for t in con.execute(f"DESCRIBE {sql}").fetchall()] if False else None
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows)}
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["cols_match"]:
        out["cols"] = (s_cols, d_cols)
        out["match"] = False
        return out
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in idx) for r in d_rows]
    key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    s_sorted = sorted(s_rows, key=key)
    d_sorted = sorted(d_rows, key=key)
    out["match"] = s_sorted == d_sorted
    if not out["match"]:
        diff_s = [r for r in s_sorted if r not in set(d_sorted)][:3]
        diff_d = [r for r in d_sorted if r not in set(s_sorted)][:3]
        out["only_spark"] = diff_s
        out["only_duck"] = diff_d
        out["cols"] = s_cols
    # type check (DuckDB DESCRIBE of the query)
    desc = con.execute(f"DESCRIBE {sql}").fetchall()
    dt = {r[0]: r[1] for r in desc}
    bad = [(c, t, dt.get(c)) for c, t in zip(s_cols, s_types)
           if _SPARK_TO_DUCK.get(t, t.upper()) != dt.get(c) and not t.startswith(("array", "struct", "map"))]
    out["type_mismatch"] = bad
    return out


if __name__ == "__main__":
    import time

    from daybook.session import get_session
    import __spark_entry__ as E
    base = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or list(E.queries())
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session("local[8]", 8)
    con = duck(base)
    qs, os_ = E.queries(), E.oracle_sql()
    for n in names:
        t = time.time()
        if n not in os_:
            c = qs[n](spark, base).count()
            print(f"{n:28s} rows-only {c} ({time.time()-t:.1f}s)")
            continue
        try:
            r = compare(spark, n, qs[n], os_[n], base, con)
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = "OK " if r["match"] and not r["type_mismatch"] else "BAD"
        print(f"{n:28s} {ok} rows {r['spark_rows']}/{r['duck_rows']} ({time.time()-t:.1f}s)"
              + ("" if r["match"] else f" only_spark={r.get('only_spark')} only_duck={r.get('only_duck')} cols={r.get('cols')}")
              + (f" types={r['type_mismatch']}" if r["type_mismatch"] else ""))
