"""Compare a Spark query with its DuckDB twin the way the correctness gate does:
row count, column names (sorted), and order-insensitive values."""

from __future__ import annotations

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
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols), "spark_cols": s_cols, "oracle_cols": d_cols}
    if out["cols_match"]:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        out["values_match"] = a == b
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            out["first_diffs"] = diff
    else:
        out["values_match"] = False
    return out
