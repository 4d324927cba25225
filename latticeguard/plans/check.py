"""Spark-vs-DuckDB comparison used by tests and the local check script.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values (columns sorted by name, floats compared at 1e-6).
"""
from __future__ import annotations

import datetime as dt
import decimal
import math

from ..sources.tables import TABLES


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols), "spark_cols": s_cols, "oracle_cols": d_cols}
    if not out["columns_match"]:
        out["values_match"] = False
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows), key=_key)
    mismatches = [(a, b) for a, b in zip(s_norm, d_norm) if a != b]
    out["values_match"] = len(s_norm) == len(d_norm) and not mismatches
    out["first_mismatches"] = mismatches[:3]
    return out
