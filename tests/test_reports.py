"""Report semantics: correlation guard (A8), labels (T7), weighting (T10), ranks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickstat import schemas as S
from tickstat.operators import markets as M
from tickstat.operators import reports as R

D = dt.date(2024, 1, 5)


def ticks(spark, rows):
    """rows: (market, side, bid, ask, second_of_day)"""
    data = [(dt.datetime(2024, 1, 5, 0, 0, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s), m, "t", side,
             bid, ask, ask - bid, 0.0, "BUY", D) for m, side, bid, ask, s in rows]
    return spark.createDataFrame(data, S.PRICE_CHANGES)


def dim(spark, rows):
    return spark.createDataFrame(rows, S.DIM_MARKETS)


def test_corr_null_for_one_point_and_zero_variance(spark):
    t = ticks(spark, [("a", "YES", 0.5, 0.6, 1),
                      ("b", "YES", 0.5, 0.6, 1), ("b", "YES", 0.5, 0.6, 2),
                      ("c", "YES", 0.1, 0.6, 1), ("c", "YES", 0.2, 0.6, 2), ("c", "NO", 0.9, 0.95, 3)])
    corr = {r.market_id: r.price_trend_corr for r in R.market_day_stats(t).collect()}
    assert corr["a"] is None and corr["b"] is None
    assert corr["c"] == pytest.approx(1.0)


def test_stddev_null_for_single_tick(spark):
    t = ticks(spark, [("a", "YES", 0.5, 0.6, 1)])
    assert R.market_day_stats(t).first().spread_volatility is None


def test_unknown_labels(spark):
    t = ticks(spark, [("known", "YES", 0.5, 0.6, 1), ("nocat", "NO", 0.5, 0.6, 1),
                      ("missing", "YES", 0.5, 0.6, 1), ("ghost", "YES", 0.5, 0.6, 1)])
    d = dim(spark, [("known", "q", "e", "Politics", "politics", "2024-01-09", False, None, False),
                    ("nocat", "q", "e", None, None, "junk", False, None, False),
                    ("ghost", "Ghost", "Unknown", "Unknown", "unknown", None, None, None, True)])
    view = M.markets_view(d)
    assert view.where(F.col("market_id") == "ghost").count() == 0
    h = {r.market_id: r for r in R.market_history(t, view).collect()}
    assert h["nocat"].category == "Unknown" and h["nocat"].end_date is None
    assert h["missing"].category == S.MISSING_CATEGORY and h["missing"].question == S.MISSING_QUESTION
    assert h["ghost"].category_slug == S.MISSING_SLUG
    cats = {r.category for r in R.category_activity(t, view).collect()}
    assert cats == {"Politics", "Unknown", S.MISSING_CATEGORY}


def test_activity_is_tick_weighted_and_expiry_market_weighted(spark):
    t = ticks(spark, [("a", "YES", 0.5, 0.6, 1), ("a", "YES", 0.5, 0.6, 2), ("a", "NO", 0.5, 0.6, 3),
                      ("b", "YES", 0.5, 0.9, 1)])
    d = dim(spark, [("a", "q", "e", "X", "x", "2024-01-06", False, None, False),
                    ("b", "q", "e", "X", "x", "2024-01-06", False, None, False)])
    view = M.markets_view(d)
    act = R.category_activity(t, view).first()
    assert act.avg_spread == pytest.approx((0.1 * 3 + 0.4) / 4)
    assert act.market_count == 2 and act.tick_count == 4
    exp = R.expiry_buckets(R.market_history(t, view)).first()
    assert exp.expiry_bucket == "0-1d" and exp.expiry_bucket_order == 1
    assert exp.avg_spread == pytest.approx((0.1 + 0.4) / 2)
    assert exp.avg_days_to_expiry == pytest.approx(1.0) and exp.market_count == 2


@pytest.mark.parametrize("days,label,order", [(-1, "expired", 5), (0, "0-1d", 1), (1, "0-1d", 1),
                                              (2, "2-7d", 2), (7, "2-7d", 2), (8, "8-30d", 3),
                                              (30, "8-30d", 3), (31, "31d+", 4)])
def test_expiry_bucket_edges(spark, days, label, order):
    end = (D + dt.timedelta(days=days)).isoformat()
    t = ticks(spark, [("a", "YES", 0.5, 0.6, 1)])
    view = M.markets_view(dim(spark, [("a", "q", "e", "X", "x", end, False, None, False)]))
    r = R.expiry_buckets(R.market_history(t, view)).first()
    assert (r.expiry_bucket, r.expiry_bucket_order) == (label, order)


def test_concentration_ranks_ties_by_id_and_shares(spark):
    rows = [(m, "YES", 0.5, 0.6, s) for m, n in (("b", 2), ("a", 2), ("c", 1), ("d", 1)) for s in range(n)]
    t = ticks(spark, rows)
    view = M.markets_view(dim(spark, [(m, m, "e", "X", "x", None, False, None, False) for m in "abcd"]))
    stats = R.market_day_stats(t)
    c = {r.market_id: r for r in R.category_concentration(
        R.market_history(None, view, stats=stats), R.category_activity(None, view, stats=stats)).collect()}
    assert [c[m].market_rank_in_category for m in "abcd"] == [1, 2, 3, 4]
    assert c["a"].market_tick_share == pytest.approx(2 / 6)
    assert c["d"].top_3_market_share == pytest.approx(5 / 6)
    assert c["d"].hhi_concentration_index == pytest.approx((4 + 4 + 1 + 1) / 36)
    assert c["d"].active_markets == 4 and c["d"].top_market_share == pytest.approx(1 / 3)


def test_hour_buckets(spark):
    t = ticks(spark, [("a", "YES", 0.5, 0.6, 10), ("a", "NO", 0.5, 0.7, 3700)])
    rows = sorted(R.spread_over_time(t).collect(), key=lambda r: r.hour)
    assert len(rows) == 2 and rows[0].yes_avg_bid == 0.5 and rows[1].yes_avg_bid is None
    assert rows[0].stddev_spread is None


def test_history_joins_after_aggregation(spark):
    t = ticks(spark, [("a", "YES", 0.5, 0.6, 1)])
    view = M.markets_view(dim(spark, [("a", "q", "e", "X", "x", None, False, None, False)]))
    plan = R.market_history(t, view)._jdf.queryExecution().optimizedPlan().toString()
    # the aggregate sits below the join: the dimension meets market-days, not ticks
    assert plan.index("Join") < plan.index("Aggregate")


def test_repeated_view_rows_weigh_the_aggregates(spark):
    t = ticks(spark, [("a", "YES", 0.5, 0.6, 1), ("a", "YES", 0.5, 0.7, 2)])
    row = ("a", "q", "e", "X", "x", None, False, None, False)
    view = M.markets_view(dim(spark, [row, row]))
    joined = t.join(view, "market_id", "left")                       # the plain form: join first
    h = R.market_history(t, view).collect()
    assert len(h) == 1 and h[0].tick_count == 4
    assert h[0].spread_volatility == pytest.approx(joined.agg(F.stddev_samp("spread")).first()[0])
    act = R.category_activity(t, view).first()
    assert (act.market_count, act.tick_count) == (1, 4)
    other = M.markets_view(dim(spark, [row, ("a", "q2", *row[2:])]))
    assert sorted(r.tick_count for r in R.market_history(t, other).collect()) == [2, 2]
    assert R.category_activity(t, other).first().market_count == 1


def test_null_ids_are_no_market(spark):
    t = ticks(spark, [(None, "YES", 0.5, 0.6, 1), (None, "NO", 0.5, 0.6, 2), ("zz", "NO", 0.5, 0.6, 3)])
    act = R.category_activity(t, M.markets_view(dim(spark, []))).first()
    assert (act.market_count, act.tick_count) == (1, 3)


def test_concentration_totals_from_history_equal_the_activity(spark):
    rows = [(m, "YES", 0.5, 0.6, s) for m, n in (("b", 2), ("a", 5), ("c", 1)) for s in range(n)]
    t = ticks(spark, rows)
    view = M.markets_view(dim(spark, [(m, m, "e", "X" if m != "c" else "Y", "x", None, False, None, False) for m in "abc"]))
    h = R.market_history(t, view)
    one = sorted(map(tuple, R.category_concentration(h).collect()))
    two = sorted(map(tuple, R.category_concentration(h, R.category_activity(t, view)).select(
        *R.category_concentration(h).columns).collect()))
    assert one == two


def test_distinct_markets_of_any_range(spark):
    """Merged sketches against the exact count, over 1 to 30 days."""
    days = spark.range(30).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"), "id")
    ids = spark.range(3_000).select(F.col("id").alias("m"))
    stats = days.join(ids, F.pmod(F.xxhash64("id", "m"), F.lit(5)) == 0).select(
        "date", F.concat(F.lit("m"), F.col("m").cast("string")).alias("market_id"))
    markets = ids.select(F.concat(F.lit("m"), F.col("m").cast("string")).alias("market_id"),
                         F.when(F.col("m") < 20, "small").when(F.col("m") < 2_900, "large").alias("category"))
    sketches = R.category_market_sketches(stats, markets).cache()
    joined = stats.join(markets, "market_id").withColumn("category", F.coalesce("category", F.lit("Unknown / Deleted")))
    for end in ("2024-01-02", "2024-01-05", "2024-01-31"):
        exact = {r.category: r.n for r in joined.where(F.col("date") < end).groupBy("category").agg(F.count_distinct("market_id").alias("n")).collect()}
        got = {r.category: r.market_estimate for r in R.distinct_markets(sketches, "2024-01-01", end).collect()}
        assert set(got) == set(exact) == {"small", "large", "Unknown / Deleted"}
        assert got["small"] == exact["small"]
        assert all(abs(got[c] - n) <= 0.05 * n for c, n in exact.items())
    per_day = {(r.date, r.category): r.market_count for r in sketches.collect()}
    want = {(r.date, r.category): r.n for r in joined.groupBy("date", "category").agg(F.count_distinct("market_id").alias("n")).collect()}
    assert per_day == want
