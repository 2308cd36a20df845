"""Spark result vs DuckDB oracle: row count, column names, values (order-free)."""

from __future__ import annotations

import datetime as dt
import os
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute(f"SET TimeZone = '{os.environ.get('DUCK_TZ', 'UTC')}'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, digits) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _canon(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _canon(v.asDict(recursive=True), digits)
    return v


def compare(spark_df, con, sql: str, digits: int = 7) -> dict:
    cols = spark_df.columns
    rows = spark_df.collect()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    out = {"spark_rows": len(rows), "oracle_rows": len(drows),
           "columns_match": sorted(cols) == sorted(dcols)}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = cols, dcols
        out["match"] = False
        return out
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    a = Counter(tuple(_canon(r[i], digits) for i in si) for r in rows)
    b = Counter(tuple(_canon(r[i], digits) for i in di) for r in drows)
    out["match"] = a == b
    if not out["match"]:
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
        out["columns"] = order
    return out
