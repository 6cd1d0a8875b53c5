"""Run a driver query on Spark and its oracle on DuckDB and compare (rows, columns, values)."""

from __future__ import annotations

import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("HARNESS_EXACT") == "1"


def _norm(v):
    if v is None:
        return (0, "")
    if EXACT and isinstance(v, float):
        return (1, repr(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{v:.6g}" if abs(v) < 1e-9 else f"{round(v, 6):.12g}")
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    if isinstance(v, (int,)):
        return (1, f"{float(v):.12g}")
    from decimal import Decimal
    if isinstance(v, Decimal):
        return (1, f"{round(float(v), 6):.12g}")
    if isinstance(v, (list, tuple)):
        return (3, str([_norm(x) for x in v]))
    return (4, str(v))


def compare(spark_df, sql: str, con) -> dict:
    scols = spark_df.columns
    srows = [tuple(r[c] for c in scols) for r in spark_df.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"spark_rows": len(srows), "oracle_rows": len(drows), "spark_cols": scols, "oracle_cols": dcols}
    if sorted(scols) != sorted(dcols):
        out["ok"] = False
        out["why"] = "columns differ"
        return out
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s = sorted(tuple(_norm(r[i]) for i in si) for r in srows)
    d = sorted(tuple(_norm(r[i]) for i in di) for r in drows)
    out["ok"] = s == d
    if not out["ok"]:
        diff_s = [r for r in s if r not in set(d)][:3]
        diff_d = [r for r in d if r not in set(s)][:3]
        out["why"] = f"values differ; spark-only {diff_s} oracle-only {diff_d}"
    return out
