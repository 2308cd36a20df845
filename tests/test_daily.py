"""The daily job end to end on a landed raw table: results equal the direct
queries, re-runs are idempotent and a re-run window replaces only its dates."""

import tempfile

from pyspark.sql import functions as F

from compare import _canon
from conftest import SF_SMALL
from tickstat.operators import sinks as SK
from tickstat.plans import daily, registry as G
from tickstat.sources import raw as RAW


def rows(df, digits=7):
    cols = sorted(df.columns)
    return sorted((tuple(_canon(r[c], digits) for c in cols) for r in df.collect()), key=repr)


def test_daily_job(spark):
    root = tempfile.mkdtemp(prefix="ts-daily-")
    # land the raw order book as a date-partitioned table, as the loader does
    ob = G.orderbook(spark, SF_SMALL).withColumn("date", F.to_date("timestamp_received"))
    SK.overwrite_partitions(ob, f"{root}/raw", cluster_by=["market_id", "update_type"])
    dim = G.dim(spark, SF_SMALL)
    start, end = "2024-01-01", "2024-01-31"
    raw = RAW.scan_raw(spark, f"{root}/raw", start, end)
    res = daily.run_window(spark, raw, dim, f"{root}/out", start, end)
    assert not [r for r in res.report if not r["passed"] and r["blocking"]]
    raw_checks = [r for r in res.report if r["table"] == "orderbook"]
    assert len(raw_checks) == 3 and all(r["passed"] for r in raw_checks)   # observed during the parse

    def table(name):
        return G.present(spark.read.parquet(res.paths[name]).select(*G.QUERIES[name](spark, SF_SMALL).columns))

    for name in ("price_changes", "market_history", "category_activity", "spread_over_time",
                 "spread_distribution", "expiry_buckets", "category_concentration"):
        assert rows(table(name)) == rows(G.queries()[name](spark, SF_SMALL)), name

    # re-run one sub-window: same result, other dates untouched
    before = rows(table("market_history"))
    daily.run_window(spark, RAW.scan_raw(spark, f"{root}/raw", "2024-01-10", "2024-01-12"), dim,
                     f"{root}/out", "2024-01-10", "2024-01-12")
    assert rows(table("market_history")) == before

    # a window whose raw data vanished: its dates are emptied in every table
    empty_raw = raw.where(F.lit(False))
    res2 = daily.run_window(spark, empty_raw, dim, f"{root}/out", "2024-01-05", "2024-01-06",
                            gate=False)
    assert [str(d) for d in res2.emptied["price_changes"]] == ["2024-01-05"]
    dates = {str(r.date) for r in spark.read.parquet(res.paths["market_history"]).select("date").distinct().collect()}
    assert "2024-01-05" not in dates and "2024-01-04" in dates
    failed = {r["check"] for r in res2.report if not r["passed"]}
    assert "ticks have rows" in failed


def test_raw_scan_prunes_partitions(spark):
    root = tempfile.mkdtemp(prefix="ts-scan-")
    ob = G.orderbook(spark, SF_SMALL).withColumn("date", F.to_date("timestamp_received"))
    SK.overwrite_partitions(ob, f"{root}/raw")
    df = RAW.scan_raw(spark, f"{root}/raw", "2024-01-03", "2024-01-04").select("market_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-03" in plan
    assert "ReadSchema: struct<market_id:string>" in plan
    assert df.count() == ob.where(F.col("date") == "2024-01-03").count()


def test_backfill_in_windows_equals_one_run(spark):
    root = tempfile.mkdtemp(prefix="ts-backfill-")
    ob = G.orderbook(spark, SF_SMALL).withColumn("date", F.to_date("timestamp_received"))
    SK.overwrite_partitions(ob, f"{root}/raw")
    dim = G.dim(spark, SF_SMALL)
    results = daily.run_backfill(spark, f"{root}/raw", dim, f"{root}/chunked", "2024-01-01", "2024-01-08",
                                 days_per_run=3)
    assert len(results) == 3
    one = daily.run_window(spark, RAW.scan_raw(spark, f"{root}/raw", "2024-01-01", "2024-01-08"), dim,
                           f"{root}/single", "2024-01-01", "2024-01-08")
    for name in ("market_history", "spread_over_time", "category_concentration"):
        a = spark.read.parquet(results[0].paths[name])
        b = spark.read.parquet(one.paths[name])
        assert rows(a) == rows(b), name


def landed_tables(spark, root):
    from tickstat.sources import fixtures as FX
    ob = G.orderbook(spark, SF_SMALL).withColumn("date", F.to_date("timestamp_received"))
    SK.overwrite_partitions(ob, f"{root}/raw", cluster_by=["market_id", "update_type"])
    customer = G.table(spark, SF_SMALL, "customer")
    return (RAW.scan_raw(spark, f"{root}/raw"), FX.market_payload_from_customer(customer),
            FX.event_tags_from_customer(customer))


def test_full_chain_from_an_empty_dimension(spark):
    root = tempfile.mkdtemp(prefix="ts-chain-")
    raw, payload, tags = landed_tables(spark, root)
    window = ("2024-01-03", "2024-01-06")
    res = daily.run_daily(spark, raw, f"{root}/dim", payload, tags, f"{root}/out", *window)
    ids = raw.where(F.col("date").between("2024-01-03", "2024-01-05")).select("market_id").distinct().count()
    dim = spark.read.parquet(f"{root}/dim")
    assert dim.count() == ids and dim.where("is_ghost").count() > 0
    assert {r["table"] for r in res.report} >= {"dim_markets", "markets_view", "orderbook", "market_history"}
    daily.run_daily(spark, raw, f"{root}/dim", payload, tags, f"{root}/out", *window)     # nothing new
    assert spark.read.parquet(f"{root}/dim").count() == ids
    history = spark.read.parquet(res.paths["market_history"])
    assert history.groupBy("date", "market_id").count().where("count > 1").count() == 0


def test_a_null_id_stops_the_run(spark):
    import pytest
    from tickstat import schemas
    from tickstat.operators import quality as Q
    root = tempfile.mkdtemp(prefix="ts-gate-")
    raw, payload, tags = landed_tables(spark, root)
    SK.ensure_table(spark, f"{root}/dim", schemas.DIM_MARKETS, partition_col=None)
    spark.createDataFrame([(None, "q", "e", None, None, None, False, None, False)], schemas.DIM_MARKETS) \
        .write.mode("append").parquet(f"{root}/dim")
    with pytest.raises(Q.QualityError, match="dimension rows have an id"):
        daily.run_daily(spark, raw, f"{root}/dim", payload, tags, f"{root}/out", "2024-01-03", "2024-01-04")
    import os
    assert not os.path.exists(f"{root}/out")


def test_tick_scan_gets_the_update_type(spark):
    root = tempfile.mkdtemp(prefix="ts-push-")
    raw, _, _ = landed_tables(spark, root)
    from tickstat.operators import quality as Q
    from tickstat.operators import ticks as K
    observed, _ = Q.observe_rules(K.price_changes(raw, "2024-01-03", "2024-01-04"), Q.ticks_rules(), table="t")
    plan = observed._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(update_type,price_change)" in plan and "2024-01-03" in plan


def payload_lines(spark, root, spoil):
    """The landed metadata as JSON lines, changed by ``spoil(list of lines)``."""
    import os
    from tickstat.sources import fixtures as FX
    payload = FX.market_payload_from_customer(G.table(spark, SF_SMALL, "customer"))
    lines = [r.v for r in payload.select(F.to_json(F.struct(*payload.columns)).alias("v")).collect()]
    os.makedirs(f"{root}/payload", exist_ok=True)
    with open(f"{root}/payload/a.json", "w", encoding="utf-8") as f:
        f.write("\n".join(spoil(lines)) + "\n")
    return f"{root}/payload"


def test_repeated_and_malformed_metadata(spark):
    """A market in two landed lines and lines that are no JSON: the run goes
    through, counts them, and the next one too."""
    from tickstat.sources.payload import read_market_payload, split_payload
    root = tempfile.mkdtemp(prefix="ts-repeat-")
    raw, _, tags = landed_tables(spark, root)
    window = ("2024-01-03", "2024-01-06")
    wanted = {r.market_id for r in raw.where(F.col("date").between("2024-01-03", "2024-01-05")).select("market_id").distinct().collect()}
    def spoil(lines):
        ids = [x.split('"')[3] for x in lines]
        twice = next(i for i, k in enumerate(ids) if k in wanted)
        cut = next(i for i, k in enumerate(ids) if k in wanted and i != twice)
        spoil.cut = ids[cut]
        return [*(x[:25] if i == cut else x for i, x in enumerate(lines)), lines[twice], lines[twice].replace("Customer", "Again"), "no json", "[1]"]

    payload = read_market_payload(spark, payload_lines(spark, root, spoil), quarantine=True)
    good, bad = split_payload(payload)
    assert sorted(len(r.line) for r in bad.collect()) == [3, 7, 25] and all(r.file for r in bad.collect())
    for _ in range(2):
        res = daily.run_daily(spark, raw, f"{root}/dim", payload, tags, f"{root}/out", *window)
        dim = spark.read.parquet(f"{root}/dim")
        assert dim.count() == len(wanted) == dim.select("market_id").distinct().count()
        found = {r["check"]: r["violations"] for r in res.report if r["table"] == "market_payload"}
        assert found["lines are well-formed"] == 3
    assert dim.where((F.col("market_id") == spoil.cut) & F.col("is_ghost")).count() == 1

    # the line is landed whole: its ghost is looked up again, the view has it
    from tickstat.operators import markets as M
    mended = read_market_payload(spark, payload_lines(spark, root, lambda lines: lines))
    daily.run_daily(spark, raw, f"{root}/dim", mended, tags, f"{root}/out", *window, retry_ghosts=True)
    view = M.markets_view(spark.read.parquet(f"{root}/dim"))
    assert view.where(F.col("market_id") == spoil.cut).count() == 1
    assert view.count() == view.select("market_id").distinct().count()
    n = spark.read.parquet(f"{root}/dim").count()
    daily.run_daily(spark, raw, f"{root}/dim", mended, tags, f"{root}/out", *window, retry_ghosts=True)
    assert spark.read.parquet(f"{root}/dim").count() == n


def test_nothing_is_appended_when_the_gate_blocks(spark):
    import pytest
    from tickstat import schemas
    from tickstat.operators import quality as Q
    root = tempfile.mkdtemp(prefix="ts-block-")
    raw, payload, tags = landed_tables(spark, root)
    SK.ensure_table(spark, f"{root}/dim", schemas.DIM_MARKETS, partition_col=None)
    row = ("m1", "q", "e", None, None, None, False, None, False)
    spark.createDataFrame([row, row], schemas.DIM_MARKETS).write.mode("append").parquet(f"{root}/dim")
    with pytest.raises(Q.QualityError, match="unique"):
        daily.run_daily(spark, raw, f"{root}/dim", payload, tags, f"{root}/out", "2024-01-03", "2024-01-04")
    assert spark.read.parquet(f"{root}/dim").count() == 2


def test_facts_are_not_read_to_be_checked(spark, monkeypatch):
    """Same report as checking the written tables, without scanning them for it."""
    from tickstat.operators import quality as Q
    root = tempfile.mkdtemp(prefix="ts-observe-")
    raw, _, _ = landed_tables(spark, root)
    window, checked = ("2024-01-03", "2024-01-06"), []
    real = Q.quality_report
    monkeypatch.setattr(Q, "quality_report", lambda df, rules, **kw: (checked.append(kw.get("table")), real(df, rules, **kw))[1])
    res = daily.run_window(spark, raw, G.dim(spark, SF_SMALL), f"{root}/out", *window)
    assert checked == ["orderbook"]
    monkeypatch.undo()
    for name in daily.TABLES:
        want = {r.check: r.violations for r in
                Q.quality_report(daily.read_window(spark, res.paths[name], *window), daily.RULES[name]()).collect()}
        assert {r["check"]: r["violations"] for r in res.report if r["table"] == name} == want, name


def test_daily_job_on_catalog_tables(spark):
    root = tempfile.mkdtemp(prefix="ts-catalog-")
    raw, _, _ = landed_tables(spark, root)
    prefix, window = f"cat{abs(hash(root)) % 10**9}_", ("2024-01-03", "2024-01-06")
    for _ in range(2):
        daily.run_window(spark, raw, G.dim(spark, SF_SMALL), f"{root}/cat", *window, catalog=prefix)
    plain = daily.run_window(spark, raw, G.dim(spark, SF_SMALL), f"{root}/plain", *window)
    for name in daily.TABLES:
        assert rows(spark.table(prefix + name)) == rows(spark.read.parquet(plain.paths[name])), name
        spark.sql(f"DROP TABLE {prefix}{name}")


def test_a_failing_window_does_not_stop_a_backfill(spark):
    import os
    import pytest
    root = tempfile.mkdtemp(prefix="ts-failing-")
    raw, _, _ = landed_tables(spark, root)
    folder = f"{root}/raw/date=2024-01-03"
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            with open(f"{folder}/{f}", "wb") as out:
                out.write(b"PAR1 broken PAR1")
    with pytest.raises(daily.BackfillFailures, match="2024-01-03") as caught:
        daily.run_backfill(spark, f"{root}/raw", G.dim(spark, SF_SMALL), f"{root}/out", "2024-01-02", "2024-01-05", days_per_run=1)
    assert [(str(a), str(b)) for a, b, _ in caught.value.failed] == [("2024-01-03", "2024-01-04")]
    dates = {str(r.date) for r in spark.read.parquet(f"{root}/out/market_history").select("date").distinct().collect()}
    assert dates == {"2024-01-02", "2024-01-04"} and len(caught.value.results) == 2
