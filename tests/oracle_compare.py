"""Run a named Spark query and its DuckDB SQL on the same parquet files
and compare: column names, row count, and the multiset of rows (columns
sorted by name, order ignored)."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

ROUND = False  # exact equality (set True to compare floats to 12 significant digits)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    """Value plus its Python type, so an int/float or date/str mismatch
    between the engines fails even where the values compare equal."""
    if isinstance(v, float):
        if math.isnan(v):
            return ("float", "nan")
        return ("float", float(f"{v:.12g}") if ROUND else v)
    return (type(v).__name__, v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str):
    df = query(spark, sf_dir)
    s_cols = list(df.columns)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duckdb={sorted(d_cols)}")
        return problems, len(s_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duckdb={len(d_rows)}")
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        problems.append(f"values differ: spark-only {only_s} duckdb-only {only_d}")
    return problems, len(s_rows)
