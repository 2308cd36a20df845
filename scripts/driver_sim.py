"""Driver-like check: a plain local[*] session, the entry file loaded by path,
an entry() smoke run, then every query against its oracle SQL compared on the
exact float repr (no rounding in the comparison). Runs from any directory."""

import datetime as dt
import importlib.util
import os
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def canon(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    return v


def main():
    spec = importlib.util.spec_from_file_location(
        "entry", os.path.join(HERE, "..", "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    spark = (SparkSession.builder.master("local[*]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    print("entry rows", len(entry.entry(spark).collect()))

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    sql = entry.oracle_sql()
    ok = bad = 0
    for name, fn in entry.queries().items():
        df = fn(spark, sf)
        cols, rows = df.columns, df.collect()
        if name not in sql:
            print("rows-only", name, len(rows))
            continue
        rel = con.sql(sql[name])
        dcols, drows = rel.columns, rel.fetchall()
        order = sorted(cols)
        same_cols = sorted(dcols) == order
        a = Counter(tuple(canon(r[cols.index(c)]) for c in order) for r in rows)
        b = Counter(tuple(canon(r[dcols.index(c)]) for c in order) for r in drows) \
            if same_cols else None
        if a == b:
            ok += 1
        else:
            bad += 1
            print("MISMATCH", name, len(rows), len(drows), same_cols)
    print("exact repr matches", ok, "mismatches", bad)


if __name__ == "__main__":
    main()
