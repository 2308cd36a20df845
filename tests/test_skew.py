"""One market holding a third of all ticks: results stay exact, aggregation is
partial before any shuffle, and the written layout splits the hot market."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from tickstat import schemas as S
from tickstat.operators import markets as M
from tickstat.operators import ranking
from tickstat.operators import reports as R
from tickstat.operators import sinks as SK


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30000
    base = dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc)
    ids = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), (F.col("id") % 500).cast("string"))).alias("market_id"),
        (F.lit(base) + F.make_interval(secs=(F.col("id") % 86400).cast("int"))).alias("timestamp_received"),
        F.when(F.col("id") % 2 == 0, "YES").otherwise("NO").alias("side"),
        ((F.col("id") % 400) / 1000).alias("best_bid"))
    t = ids.select("timestamp_received", "market_id", F.lit("tok").alias("token_id"), "side", "best_bid",
                   (F.col("best_bid") + 0.01).alias("best_ask"), F.lit(0.01).alias("spread"),
                   F.lit(1.0).alias("change_size"), F.lit("BUY").alias("change_side"),
                   F.to_date("timestamp_received").alias("date"))
    return t.repartition(8)


def test_hot_market_exact(spark, skewed):
    stats = {r.market_id: r.tick_count for r in R.market_day_stats(skewed).collect()}
    assert stats["hot"] == 10000 and sum(stats.values()) == 30000


def test_partial_aggregation_before_shuffle(spark, skewed):
    plan = R.market_day_stats(skewed)._jdf.queryExecution().executedPlan().toString()
    lines = [ln for ln in plan.splitlines() if "HashAggregate" in ln or "Exchange hashpartitioning" in ln]
    assert "partial_count" in lines[-1]          # map-side combine sits below the exchange


def test_history_join_sees_one_row_per_market_day(spark, skewed):
    view = M.markets_view(spark.createDataFrame([("hot", "q", "e", "X", "x", None, False, None, False)], S.DIM_MARKETS))
    h = R.market_history(skewed, view)
    assert h.where(F.col("market_id") == "hot").count() == 1


def test_layout_splits_hot_market(spark, skewed):
    path = tempfile.mkdtemp(prefix="ts-skew-") + "/t"
    # scale the partition targets down to the test's size (at scale they are MBs)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        SK.write_window(skewed, path, "2024-01-05", "2024-01-06", cluster_by=["market_id"],
                        tie_breaker="timestamp_received")
    finally:
        for k in small:
            spark.conf.unset(k)
    files = spark.read.parquet(path).where(F.col("market_id") == "hot") \
        .select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1
    assert spark.read.parquet(path).count() == 30000


@pytest.fixture(scope="module")
def hot_category(spark):
    """Market-days of which one category-day has a million, with many ties."""
    n = 1_000_000
    rows = spark.range(n + 3_000).select(
        F.lit(dt.date(2024, 1, 5)).alias("date"),
        F.when(F.col("id") < n, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("category"),
        F.concat(F.lit("m"), F.xxhash64("id").cast("string")).alias("market_id"), F.lit("q").alias("question"),
        (1 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)) * (F.col("id") % 5 == 0).cast("long")).alias("tick_count"),
        F.lit(0.01).alias("avg_spread"), F.lit(0.0).alias("spread_volatility"))
    return rows.repartition(8)


def test_rank_of_a_hot_category_day(spark, hot_category):
    """The ranks and sums that windows over whole category-days give, and no
    part with more than a share of the hot one."""
    from pyspark.sql import Window
    group, order = ["date", "category"], [F.desc("tick_count"), F.asc("market_id")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = R.category_concentration(hot_category)
        dealt = ranking.deal(hot_category, group, order)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [r["count"] for r in dealt.where("category = 'hot'").groupBy(ranking.PART).count().collect()]
    assert sum(parts) == 1_000_000 and len(parts) >= 7 and max(parts) < 250_000
    w = Window.partitionBy(*group)
    share = F.col("tick_count") / F.sum("tick_count").over(w)
    want = hot_category.select(
        "category", "market_id", F.row_number().over(w.orderBy(*order)).alias("rank"), share.alias("share"),
        F.count(F.lit(1)).over(w).alias("n"), F.max("tick_count").over(w).alias("top"), F.sum("tick_count").over(w).alias("total"))
    want = want.withColumn("hhi", F.sum(F.pow("share", F.lit(2))).over(Window.partitionBy("category")))
    both = got.join(want, ["category", "market_id"])
    assert both.count() == 1_003_000
    assert both.where((F.col("rank") != F.col("market_rank_in_category")) | (F.col("n") != F.col("active_markets"))
                      | (F.abs(F.col("share") - F.col("market_tick_share")) > 1e-15)
                      | (F.abs(F.col("top") / F.col("total") - F.col("top_market_share")) > 1e-15)
                      | (F.abs(F.col("hhi") - F.col("hhi_concentration_index")) > 1e-9)).count() == 0
    threes = got.where("market_rank_in_category <= 3").groupBy("category").agg(
        F.sum("market_tick_share").alias("s"), F.max("top_3_market_share").alias("t")).collect()
    assert all(abs(r.s - r.t) < 1e-12 for r in threes)


def test_no_window_over_a_category_day(spark, hot_category):
    plan = R.category_concentration(hot_category.limit(100))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_part" in line for line in windows)


def test_rank_of_groups_without_a_name(spark):
    rows = spark.createDataFrame([(None, "b", 1), (None, "a", 1), ("x", "a", 3), (None, "c", 9)], "g string, id string, n int")
    order = [F.desc("n"), F.asc("id")]
    got = ranking.rank(ranking.deal(rows, ["g"], order), ["g"], order, "r").select("g", "id", "r").collect()
    assert {tuple(r) for r in got} == {(None, "c", 1), (None, "a", 2), (None, "b", 3), ("x", "a", 1)}
