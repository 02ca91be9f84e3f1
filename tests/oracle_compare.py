"""Run a registered Spark query and its DuckDB oracle side by side."""

from __future__ import annotations

import datetime as _dt
import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    """Compare dates and timestamps as instants, NULL/NaN/NaT as None."""
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, (pd.Timestamp, _dt.date, _dt.datetime)):
        return pd.Timestamp(v).isoformat()
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(str(_norm(x)) for x in rec))
    return sorted(out)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    o = con.execute(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"row counts differ: spark={len(s)} oracle={len(o)}"
    rs, ro = rows_of(s), rows_of(o)
    if rs != ro:
        diff = [(a, b) for a, b in zip(rs, ro) if a != b][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s)} rows"
