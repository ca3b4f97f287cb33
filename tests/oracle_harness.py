"""Run a registered Spark query and its DuckDB oracle on the same Parquet and compare.

Mirrors the driver's check: row count, column names, and an order-insensitive
multiset comparison of the values (floats compared after rounding).
"""

from __future__ import annotations

import datetime as _dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, query, sql: str, sf_dir: str, con=None) -> dict:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "columns_match": sorted(s_cols) == sorted(o_cols)}
    out["values_match"] = out["columns_match"] and _rows(s_cols, s_rows) == _rows(o_cols, o_rows)
    out["ok"] = out["values_match"] and len(s_rows) == len(o_rows)
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
    return out
