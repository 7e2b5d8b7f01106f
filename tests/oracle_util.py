"""Spark-vs-DuckDB comparison in the spirit of the driver's check: same
column names, same row count, and an order-insensitive multiset of rows
with doubles rounded to 6 places."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pandas as pd

from postlake.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, (float, np.floating)):
        if math.isnan(v):
            return None
        r = round(float(v), 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (bool, np.bool_)):
        return int(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if v is pd.NaT:
        return None
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) if not (x is pd.NaT) else None for x in rec))
    return sorted(out, key=repr)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count {len(s)} vs {len(d)}"
    rs, rd = rows(s), rows(d)
    if rs != rd:
        for a, b in zip(rs, rd):
            if a != b:
                return False, f"first differing row:\n spark {a}\n duck  {b}"
    return True, f"{len(s)} rows equal"
