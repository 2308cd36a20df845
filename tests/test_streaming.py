"""Landed hourly files are loaded exactly once; re-runs only pick up new files."""

import os
import shutil
import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickstat.operators import sinks as SK
from tickstat.operators import ticks as K
from tickstat.plans import registry as G
from tickstat.sources import raw as RAW
from tickstat.streaming import ingest
from tickstat.streaming.ingest import load_landed, reload_dates


def land(ob, root, day, hour):
    part = ob.where(F.date_format("timestamp_received", "yyyy-MM-dd'T'HH") == f"{day}T{hour:02d}")
    tmp = tempfile.mkdtemp(prefix="ts-one-")
    part.coalesce(1).write.mode("overwrite").parquet(tmp)
    src = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
    os.makedirs(f"{root}/date={day}", exist_ok=True)
    shutil.copy(f"{tmp}/{src}", f"{root}/date={day}/{day}T{hour:02d}.parquet")
    return part.count()


def test_incremental_load(spark):
    base = tempfile.mkdtemp(prefix="ts-stream-")
    landing, table, ckpt = f"{base}/landing", f"{base}/raw", f"{base}/ckpt"
    ob = G.orderbook(spark, SF_SMALL).cache()
    n = sum(land(ob, landing, "2024-01-02", h) for h in range(0, 12))
    load_landed(spark, landing, table, ckpt)
    assert spark.read.parquet(table).count() == n
    load_landed(spark, landing, table, ckpt)                # nothing new: no duplicates
    assert spark.read.parquet(table).count() == n
    n += sum(land(ob, landing, "2024-01-02", h) for h in range(12, 24))
    load_landed(spark, landing, table, ckpt)
    raw = RAW.scan_raw(spark, table, "2024-01-02", "2024-01-03")
    assert raw.count() == n
    day = ob.where(F.to_date("timestamp_received") == "2024-01-02")
    assert raw.count() == day.count()
    assert K.price_changes(raw).count() == K.price_changes(day, "2024-01-02", "2024-01-03").count()


SCRIPT = """
import sys; sys.path.insert(0, {root!r})
from tickstat.session import local_session
from tickstat.streaming.ingest import load_landed
spark = local_session(2, shuffle_partitions=2, checkpoint={ckpt!r})
load_landed(spark, {landing!r}, {table!r})
print("ROWS", spark.read.parquet({table!r}).count())
"""


def test_two_applications_load_every_file(spark):
    import subprocess
    import sys

    from conftest import ROOT
    base = tempfile.mkdtemp(prefix="ts-apps-")
    landing, table = f"{base}/landing", f"{base}/raw"
    ob = G.orderbook(spark, SF_SMALL)
    n = 0
    for hours in (range(0, 4), range(4, 9)):
        n += sum(land(ob, landing, "2024-01-02", h) for h in hours)
        code = SCRIPT.format(root=ROOT, ckpt=f"{base}/ckpt", landing=landing, table=table)
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        assert f"ROWS {n}" in out.stdout, out.stderr[-2000:]


def test_a_repeated_batch_replaces_itself(spark):
    from tickstat.streaming import ingest
    base = tempfile.mkdtemp(prefix="ts-batch-")
    landing = f"{base}/landing"
    n = sum(land(G.orderbook(spark, SF_SMALL), landing, "2024-01-02", h) for h in range(3))
    rows = ingest.landed_folder(spark, landing, date(2024, 1, 2))
    for _ in range(2):
        ingest._write(rows, f"{base}/raw", "b000000000", "overwrite")
    assert RAW.scan_raw(spark, f"{base}/raw").count() == n


def test_reload_replaces_dates_and_loading_goes_on(spark):
    base = tempfile.mkdtemp(prefix="ts-reload-")
    landing, table = f"{base}/landing", f"{base}/raw"
    ob = G.orderbook(spark, SF_SMALL)
    first = sum(land(ob, landing, "2024-01-02", h) for h in range(0, 6))
    other = land(ob, landing, "2024-01-03", 0)
    load_landed(spark, landing, table)
    once = ob.where(F.date_format("timestamp_received", "yyyy-MM-dd'T'HH") == "2024-01-02T00").count()
    land(ob.unionAll(ob), landing, "2024-01-02", 0)                        # a file landed anew, twice as large
    assert [(str(r.src), r.file) for r in ingest.changed_files(spark, landing, table).collect()] == [
        ("2024-01-02", "date=2024-01-02/2024-01-02T00.parquet")]
    report = reload_dates(spark, landing, table, "2024-01-02", "2024-01-03").collect()
    assert [(str(r.date), r.rows_before, r.rows_after, r.error) for r in report] == [
        ("2024-01-02", first, first + once, None)]
    assert ingest.changed_files(spark, landing, table).count() == 0
    assert RAW.scan_raw(spark, table).count() == first + once + other
    more = land(ob, landing, "2024-01-03", 1)
    load_landed(spark, landing, table)
    assert RAW.scan_raw(spark, table, "2024-01-03", "2024-01-04").count() == other + more
    assert RAW.scan_raw(spark, table, "2024-01-02", "2024-01-03").count() == first + once


def put(spark, landing, day, name, stamps):
    """A landed file with one row per time stamp."""
    tmp = tempfile.mkdtemp(prefix="ts-put-")
    rows = spark.createDataFrame([(t, f"m{i}", "price_change", f"{day}/{name}") for i, t in enumerate(stamps)],
                                 "t string, market_id string, update_type string, data string")
    rows = rows.select(F.to_timestamp("t").alias("timestamp_received"), F.to_timestamp("t").alias("timestamp_created_at"),
                       "market_id", "update_type", "data")
    rows.coalesce(1).write.mode("overwrite").parquet(tmp)
    os.makedirs(f"{landing}/date={day}", exist_ok=True)
    part = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
    shutil.copy(f"{tmp}/{part}", f"{landing}/date={day}/{name}.parquet")


def held(df):
    return sorted(tuple(r) for r in df.select("timestamp_received", "market_id", "update_type", "data").collect())


def landed(spark, landing):
    return held(spark.read.schema(ingest.LANDED).parquet(landing))


@pytest.fixture
def two_days(spark):
    """Four rows landed and loaded; two rows of the 15th lie in the 14th's folder."""
    base = tempfile.mkdtemp(prefix="ts-ledger-")
    landing, table = f"{base}/landing", f"{base}/raw"
    put(spark, landing, "2026-03-14", "2026-03-14T23", ["2026-03-14 23:10:00", "2026-03-15 00:00:01", "2026-03-15 00:00:02"])
    put(spark, landing, "2026-03-15", "2026-03-15T00", ["2026-03-15 00:30:00"])
    load_landed(spark, landing, table)
    return landing, table


def test_load_and_reload_agree(spark, two_days):
    landing, table = two_days
    assert held(RAW.scan_raw(spark, table)) == landed(spark, landing)
    put(spark, landing, "2026-03-15", "2026-03-15T01", ["2026-03-15 01:00:00", "2026-03-15 01:10:00", "2026-03-15 01:20:00"])
    for window in (("2026-03-15", "2026-03-16"), ("2026-03-14", "2026-03-15"), ("2026-03-14", "2026-03-16")):
        reload_dates(spark, landing, table, *window)
        assert held(RAW.scan_raw(spark, table)) == landed(spark, landing)
        load_landed(spark, landing, table)
        assert held(RAW.scan_raw(spark, table)) == landed(spark, landing)
    assert RAW.scan_raw(spark, table, "2026-03-15", "2026-03-16").count() == 6
    found = ingest.ledger(spark, table).groupBy("src").agg(F.sum("rows").alias("n")).orderBy("src").collect()
    assert [(str(r.src), r.n) for r in found] == [("2026-03-14", 3), ("2026-03-15", 4)]


def test_a_lost_memory_of_the_stream_loads_nothing_twice(spark, two_days):
    landing, table = two_days
    put(spark, landing, "2026-03-15", "2026-03-15T01", ["2026-03-15 01:00:00"])
    load_landed(spark, landing, table, checkpoint_location=tempfile.mkdtemp(prefix="ts-memory-"))
    assert held(RAW.scan_raw(spark, table)) == landed(spark, landing)


def test_a_folder_that_is_gone_leaves_no_rows(spark, two_days):
    landing, table = two_days
    os.remove(f"{landing}/date=2026-03-14/2026-03-14T23.parquet")
    os.rmdir(f"{landing}/date=2026-03-14")
    reload_dates(spark, landing, table, "2026-03-13", "2026-03-15")
    assert held(RAW.scan_raw(spark, table)) == landed(spark, landing)
    assert RAW.scan_raw(spark, table).count() == 1


def test_failing_dates_are_collected(spark, two_days):
    landing, table = two_days
    before = held(RAW.scan_raw(spark, table))
    with open(f"{landing}/date=2026-03-14/2026-03-14T22.parquet", "wb") as f:
        f.write(b"PAR1 this is no file")
    put(spark, landing, "2026-03-15", "2026-03-15T01", ["2026-03-15 01:00:00"])
    with pytest.raises(ingest.LoadFailures, match="2026-03-14") as caught:
        reload_dates(spark, landing, table, "2026-03-14", "2026-03-16")
    assert [str(d) for d, _ in caught.value.failed] == ["2026-03-14"]
    after = held(RAW.scan_raw(spark, table))
    assert len(after) == len(before) + 1 and set(before) < set(after)      # the 15th was loaded, the 14th kept
    report = reload_dates(spark, landing, table, "2026-03-14", "2026-03-16", raise_on_failure=False).collect()
    assert [(r.rows_before, r.rows_after, bool(r.error)) for r in report] == [(3, 3, True), (2, 2, False)]


STEPS = [("SK.create_mark", 1), ("_write", 1), ("_note", 1), ("SK.create_mark", 2), ("SK.remove_dir", 1),
         *(("SK.remove_dir", n) for n in range(2, 8))]


@pytest.mark.parametrize("name,call", STEPS)
@pytest.mark.parametrize("late", [False, True])
def test_a_reload_stopped_anywhere_is_old_or_new(spark, two_days, monkeypatch, name, call, late):
    """Stops before and after every step; readers see a whole folder, and the
    next load puts the table right."""
    landing, table = two_days
    old = held(RAW.scan_raw(spark, table))
    put(spark, landing, "2026-03-14", "2026-03-14T23", ["2026-03-14 23:59:59", "2026-03-15 00:00:09"])
    new = landed(spark, landing)
    owner, attribute = (ingest.SK, name[3:]) if name.startswith("SK.") else (ingest, name)
    real, calls = getattr(owner, attribute), []

    class Stopped(BaseException):
        pass

    def step(*args, **kw):
        if "landed_files" in str(args) or "_lock" in str(args):          # scratch and lock, no step of the table
            return real(*args, **kw)
        calls.append(args)
        if len(calls) == call and not late:
            raise Stopped
        result = real(*args, **kw)
        if len(calls) == call:
            raise Stopped
        return result

    monkeypatch.setattr(owner, attribute, step)
    try:
        with SK.writer_lock(spark, table):
            ingest.reload_folder(spark, landing, table, date(2026, 3, 14))
    except Stopped:
        pass
    monkeypatch.undo()
    now = held(RAW.scan_raw(spark, table))
    committed = attribute == "remove_dir" or (attribute, call, late) == ("create_mark", 2, True)
    assert now == (new if committed else old)
    load_landed(spark, landing, table)
    assert held(RAW.scan_raw(spark, table)) == now
    reload_dates(spark, landing, table, "2026-03-14", "2026-03-15")
    load_landed(spark, landing, table)
    assert held(RAW.scan_raw(spark, table)) == new


def test_one_writer_at_a_time(spark, two_days):
    landing, table = two_days
    with SK.writer_lock(spark, table):
        with pytest.raises(SK.TableLocked):
            load_landed(spark, landing, table)
    load_landed(spark, landing, table)
    SK.create_mark(spark, f"{table}/_lock")                                # left by a writer that died
    os.utime(f"{table}/_lock", (0, 0))
    reload_dates(spark, landing, table, "2026-03-14", "2026-03-15")
    assert not os.path.exists(f"{table}/_lock")


def test_new_markets_from_the_ids_of_the_loads(spark, two_days):
    from tickstat import schemas as S
    from tickstat.operators import markets as M
    landing, table = two_days
    put(spark, landing, "2026-03-15", "2026-03-15T01", [f"2026-03-15 01:00:{i:02d}" for i in range(5)])
    load_landed(spark, landing, table)
    reload_dates(spark, landing, table, "2026-03-14", "2026-03-15")
    dim = spark.createDataFrame([("m0", "q", "e", None, None, None, False, None, False)], S.DIM_MARKETS)
    for window in ((None, None), ("2026-03-14", "2026-03-15"), ("2026-03-15", "2026-03-16"), ("2026-03-16", None)):
        want = M.new_market_ids(RAW.scan_raw(spark, table), dim, *window)
        ids = ingest.market_ids(spark, table, *window)
        got = M.new_market_ids(ids, dim, *window)
        assert sorted(got.collect()) == sorted(want.collect())
    plan = M.new_market_ids(ids, dim)._jdf.queryExecution().executedPlan().toString()
    assert "/_ledger/ids" in plan and "update_type" not in plan and "data" not in plan.replace("data:", "")


def test_files_of_a_scan(spark, two_days):
    landing, _ = two_days
    files = RAW.landed_files(spark.read.parquet(landing))
    assert sorted(r.slot for r in RAW.landed_slots_from_paths(files).collect()) == ["2026-03-14T23", "2026-03-15T00"]
    assert all(r.modified for r in files.collect())
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
