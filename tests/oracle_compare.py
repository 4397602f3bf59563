"""Run a registered query on Spark and its DuckDB twin, and compare.

Mirrors the driver's gate: same column names, same row count and the same
multiset of rows (order-insensitive).  Floats are compared after rounding to
9 significant digits so a last-bit difference between engines is not a
mismatch, while any real difference is.
"""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            return 0.0
        return v if STRICT else float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        only_s = list((a - b).items())[:3]
        only_d = list((b - a).items())[:3]
        return False, f"values differ (cols {sorted(s_cols)}): spark-only={only_s} duck-only={only_d}"
    return True, f"{len(s_rows)} rows"
