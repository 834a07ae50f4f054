"""Compare a registered Spark query with its DuckDB oracle on the driver's tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def _rows(columns, records, digits):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i], digits) for i in order) for r in records]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                            for x in r))


def _digest(rows) -> str:
    return hashlib.sha256(repr(rows).encode()).hexdigest()


def compare(spark, name: str, sf_dir: str, queries: dict, oracles: dict) -> dict:
    sdf = queries[name](spark, sf_dir)
    s_cols = sdf.columns
    s_recs = [tuple(r) for r in sdf.collect()]
    con = duck(sf_dir)
    rel = con.sql(oracles[name])
    d_cols = rel.columns
    d_recs = rel.fetchall()
    out = {
        "rows_spark": len(s_recs), "rows_oracle": len(d_recs),
        "rows_match": len(s_recs) == len(d_recs),
        "columns_match": sorted(s_cols) == sorted(d_cols),
    }
    if out["columns_match"]:
        out["hash_match"] = _digest(_rows(s_cols, s_recs, None)) == _digest(_rows(d_cols, d_recs, None))
        out["close_match"] = _rows(s_cols, s_recs, 9) == _rows(d_cols, d_recs, 9)
    else:
        out["spark_columns"], out["oracle_columns"] = s_cols, d_cols
    return out
