"""Local Spark-vs-DuckDB comparison used by the tests (mirrors the driver's gate)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

from claimflow.sources.adapters import DRIVER_TABLES


def duckdb_run(sql: str, root: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def _norm(v, digits: int = 6):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) + 0.0
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def normalize(cols, rows, digits: int = 6):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, sql: str, root: str, digits: int = 6):
    """Return (ok, message). Columns compared by name; rows order-insensitive."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    d_cols, d_rows = duckdb_run(sql, root)
    sc, sr = normalize(s_cols, s_rows, digits)
    dc, dr = normalize(d_cols, d_rows, digits)
    if sc != dc:
        return False, f"columns differ: spark={sc} duckdb={dc}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duckdb={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return False, f"first differing row:\n spark ={a}\n duckdb={b}"
    return True, f"{len(sr)} rows match"
