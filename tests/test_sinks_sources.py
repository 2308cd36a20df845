"""Window replace, partition overwrite, merge writer, slots, inventory, integrity."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tickstat.operators import sinks as SK
from tickstat.sources import raw as RAW


def fact(spark, dates, tag):
    return spark.createDataFrame([(dt.date.fromisoformat(d), tag, 1) for d in dates],
                                 "date date, tag string, n int")


def test_window_replace_dataframe(spark):
    old = fact(spark, ["2024-01-09", "2024-01-10", "2024-01-15", "2024-01-20"], "old")
    new = fact(spark, ["2024-01-10"], "new")
    out = sorted((str(r.date), r.tag) for r in SK.window_replace(old, new, "2024-01-10", "2024-01-20").collect())
    assert out == [("2024-01-09", "old"), ("2024-01-10", "new"), ("2024-01-20", "old")]


def test_write_window_removes_dates_without_fresh_rows(spark):
    path = tempfile.mkdtemp(prefix="ts-win-") + "/t"
    SK.overwrite_partitions(fact(spark, ["2024-01-09", "2024-01-10", "2024-01-11"], "old"), path)
    emptied = SK.write_window(fact(spark, ["2024-01-10"], "new"), path, "2024-01-10", "2024-01-12")
    assert emptied == [dt.date(2024, 1, 11)]
    got = sorted((str(r.date), r.tag) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-09", "old"), ("2024-01-10", "new")]
    # idempotent re-run
    SK.write_window(fact(spark, ["2024-01-10"], "new"), path, "2024-01-10", "2024-01-12")
    assert spark.read.parquet(path).count() == 2


def test_dynamic_overwrite_keeps_other_dates(spark):
    path = tempfile.mkdtemp(prefix="ts-ow-") + "/t"
    SK.overwrite_partitions(fact(spark, ["2024-01-01", "2024-01-02"], "a"), path)
    SK.overwrite_partitions(fact(spark, ["2024-01-02"], "b"), path)
    got = sorted((str(r.date), r.tag) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", "a"), ("2024-01-02", "b")]


def test_ensure_table_and_append_inserts(spark):
    from tickstat import schemas as S
    path = tempfile.mkdtemp(prefix="ts-dim-") + "/dim"
    assert SK.ensure_table(spark, path, S.DIM_MARKETS, partition_col=None)
    assert not SK.ensure_table(spark, path, S.DIM_MARKETS, partition_col=None)
    row = lambda i, q: (i, q, "e", None, None, None, False, None, False)
    SK.append_inserts(path, spark.createDataFrame([row("a", "1"), row("b", "2")], S.DIM_MARKETS))
    SK.append_inserts(path, spark.createDataFrame([row("a", "changed"), row("c", "3")], S.DIM_MARKETS))
    got = sorted((r.market_id, r.question) for r in spark.read.parquet(path).collect())
    assert got == [("a", "1"), ("b", "2"), ("c", "3")]


def test_slots(spark):
    s = RAW.hour_slots(spark, "2024-01-01", "2024-01-02").collect()
    assert len(s) == 24 and s[0].slot == "2024-01-01T00" and s[-1].slot == "2024-01-01T23"
    assert RAW.hour_slots(spark, "2024-01-01", "2024-01-01").count() == 0
    assert [str(r.date) for r in RAW.date_slots(spark, "2024-01-30", "2024-02-02").collect()] == \
        ["2024-01-30", "2024-01-31", "2024-02-01"]
    assert RAW.date_slots(spark, "2024-01-01", "2024-01-01").count() == 0


def test_missing_slots_and_gate(spark):
    expected = RAW.hour_slots(spark, "2024-01-01", "2024-01-02")
    paths = spark.createDataFrame([(f"/l/date=2024-01-01/2024-01-01T{h:02d}.parquet",) for h in range(24) if h != 5],
                                  "path string")
    landed = RAW.landed_slots_from_paths(paths)
    assert [r.slot for r in RAW.missing_slots(expected, landed).collect()] == ["2024-01-01T05"]
    summary = RAW.completeness(RAW.slot_status(expected, landed))
    with pytest.raises(RuntimeError, match="2024-01-01T05"):
        RAW.completeness_gate(summary)


def test_inventory_and_integrity(spark):
    root = tempfile.mkdtemp(prefix="ts-land-")
    for d in ("2024-01-01", "2024-01-02"):
        spark.range(10).write.parquet(f"{root}/tmp_{d}")
        os.makedirs(f"{root}/date={d}")
        src = [f for f in os.listdir(f"{root}/tmp_{d}") if f.endswith(".parquet")][0]
        os.rename(f"{root}/tmp_{d}/{src}", f"{root}/date={d}/{d}T00.parquet")
    bad = f"{root}/date=2024-01-02/2024-01-02T01.parquet"
    with open(f"{root}/date=2024-01-01/2024-01-01T00.parquet", "rb") as f:
        data = f.read()
    with open(bad, "wb") as f:
        f.write(data[: len(data) // 2])          # truncated upload
    inv = RAW.file_inventory(spark, root).where(F.col("date").isNotNull())
    rows = {r.file_name: r for r in inv.collect()}
    assert set(rows) == {"2024-01-01T00.parquet", "2024-01-02T00.parquet", "2024-01-02T01.parquet"}
    assert str(rows["2024-01-02T01.parquet"].date) == "2024-01-02"
    ok = {r.path.rsplit("/", 1)[-1]: r.ok for r in RAW.parquet_integrity(inv).collect()}
    assert ok == {"2024-01-01T00.parquet": True, "2024-01-02T00.parquet": True, "2024-01-02T01.parquet": False}


def test_overwrite_dates_collects_failures(spark):
    path = tempfile.mkdtemp(prefix="ts-od-") + "/t"
    df = fact(spark, ["2024-01-01", "2024-01-02"], "a")
    assert SK.overwrite_dates(df, path, "2024-01-01", "2024-01-03") == []
    assert spark.read.parquet(path).count() == 2
    bad = df.withColumn("n", F.when(F.col("date") == "2024-01-02", F.raise_error("boom")).otherwise(F.col("n")))
    failed = SK.overwrite_dates(bad, path, "2024-01-01", "2024-01-03", raise_on_failure=False)
    assert [str(d) for d, _ in failed] == ["2024-01-02"]
    with pytest.raises(RuntimeError, match="2024-01-02"):
        SK.overwrite_dates(bad, path, "2024-01-01", "2024-01-03")
    assert spark.read.parquet(path).count() == 2        # the failed date kept its old rows


def test_null_dates_stay_and_are_not_added_twice(spark):
    old = spark.createDataFrame([(None, "old", 1), (dt.date(2024, 1, 1), "old", 2)], "date date, tag string, n int")
    new = spark.createDataFrame([(dt.date(2024, 1, 1), "new", 3)], "date date, tag string, n int")
    got = sorted((r.tag, r.n) for r in SK.window_replace(old, new, "2024-01-01", "2024-01-02").collect())
    assert got == [("new", 3), ("old", 1)]
    path = tempfile.mkdtemp(prefix="ts-null-") + "/t"
    for _ in range(2):
        SK.write_window(old, path, "2024-01-01", "2024-01-02")
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("stop_at", [1, 2, 3, 4])
def test_a_stopped_swap_is_put_right(spark, monkeypatch, stop_at):
    path = tempfile.mkdtemp(prefix="ts-crash-") + "/t"
    SK.overwrite_partitions(fact(spark, ["2024-01-01", "2024-01-02", "2024-01-09"], "old"), path)
    real, calls = SK._rename, []

    def stopping(*args):
        calls.append(args)
        if len(calls) == stop_at:
            raise KeyboardInterrupt
        return real(*args)

    monkeypatch.setattr(SK, "_rename", stopping)
    with pytest.raises(KeyboardInterrupt):
        SK.write_window(fact(spark, ["2024-01-01", "2024-01-02"], "new"), path, "2024-01-01", "2024-01-03")
    monkeypatch.setattr(SK, "_rename", real)
    SK.recover(spark, path)                                  # every date is there, old or new
    dates = sorted(str(r.date) for r in spark.read.parquet(path).collect())
    assert dates == ["2024-01-01", "2024-01-02", "2024-01-09"]
    assert [d for d in os.listdir(path) if d.startswith("_staging") or d == "_aside"] == []
    SK.write_window(fact(spark, ["2024-01-01", "2024-01-02"], "new"), path, "2024-01-01", "2024-01-03")
    got = sorted((str(r.date), r.tag) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", "new"), ("2024-01-02", "new"), ("2024-01-09", "old")]


def test_unreadable_files_are_not_called_corrupt(spark):
    files = spark.createDataFrame([("/no/such/file.parquet", 1), ("nosuch://x/y.parquet", 1)], "path string, size_bytes long")
    got = RAW.parquet_integrity(files).collect()
    assert all(r.ok is None and r.error for r in got)


def test_windowed_counts_prune_partitions(spark):
    path = tempfile.mkdtemp(prefix="ts-prune-") + "/raw"
    rows = spark.range(48).selectExpr("timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,id*3) AS timestamp_received",
                                      "timestamp'2024-01-01 00:00:00' AS timestamp_created_at", "'m1' AS market_id",
                                      "'price_change' AS update_type", "'{}' AS data") \
        .withColumn("date", F.to_date("timestamp_received"))
    SK.overwrite_partitions(rows, path)
    counts = RAW.partition_row_counts(RAW.scan_raw(spark, path), "2024-01-02", "2024-01-03")
    assert [(str(r.date), r.row_count) for r in counts.collect()] == [("2024-01-02", 8)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-02" in plan
