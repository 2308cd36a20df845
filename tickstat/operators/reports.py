"""Daily and hourly liquidity facts from the cleansed ticks.

Plan shape (what keeps these cheap at 5e8+ ticks a day):

* The only tick-sized shuffles are the group-bys, and every aggregate used is
  algebraic (count/sum/avg/min/max/stddev/covariance), so Spark combines
  map-side: each task ships at most one partial row per key. A market that
  holds a third of all ticks costs the same shuffle as any other key.
* The source groups ticks by 9 keys after joining the dimension to every tick.
  Here ticks are aggregated by (date, market_id) first and the dimension is
  joined to that one-row-per-market-day result. Where the view has several rows
  of a market, the join multiplies that market's ticks as it would before the
  aggregation: equal view rows weigh the aggregates, different ones are
  separate groups. The join then sees thousands of rows, not
  billions; Spark broadcasts it when its measured size is under the
  broadcast threshold (AQE) and sort-merges it otherwise - no unchecked
  broadcast hint.
* Category activity is a roll-up of the same per-market-day aggregate (distinct
  ids, sum, tick-weighted mean): the distinct count runs over market-days, not
  over ticks.
* Expiry buckets and concentration are computed from the market-day facts
  (one row per market per day), never from ticks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import (days_to_expiry, expiry_bucket, expiry_bucket_order,
                                 guarded_corr, in_window, safe_divide, spread_tier, yes_only)
from . import ranking

HISTORY_COLUMNS = (
    "date", "market_id", "question", "event_title", "category", "category_slug", "end_date",
    "closed", "resolution_status", "tick_count", "yes_avg_bid", "yes_avg_ask", "yes_min_bid",
    "yes_max_ask", "avg_spread", "spread_volatility", "min_spread", "max_spread",
    "price_trend_corr",
)


def market_day_stats(ticks: DataFrame, start=None, end=None) -> DataFrame:
    """Per (date, market_id) aggregates over ticks with a non-negative spread.

    Also carries ``spread_sum`` and ``spread_m2`` (sum of squared deviations),
    so that category activity and repeated view rows can be worked out from
    the same result.
    """
    t = ticks.where((F.col("spread") >= 0) & in_window("date", start, end))
    unix_s = F.unix_seconds(F.col("timestamp_received").cast("timestamp"))
    return t.groupBy("date", "market_id").agg(
        F.count(F.lit(1)).alias("tick_count"),
        F.avg(yes_only("best_bid")).alias("yes_avg_bid"),
        F.avg(yes_only("best_ask")).alias("yes_avg_ask"),
        F.min(yes_only("best_bid")).alias("yes_min_bid"),
        F.max(yes_only("best_ask")).alias("yes_max_ask"),
        F.avg("spread").alias("avg_spread"),
        F.stddev_samp("spread").alias("spread_volatility"),
        F.min("spread").alias("min_spread"),
        F.max("spread").alias("max_spread"),
        guarded_corr(yes_only(unix_s.cast("double")), yes_only("best_bid")).alias("price_trend_corr"),
        F.sum("spread").alias("spread_sum"),
        (F.var_pop("spread") * F.count(F.lit(1))).alias("spread_m2"),
    )


VIEW_COLUMNS = ("question", "event_title", "category", "category_slug", "end_date", "closed",
                "resolution_status")


def market_history(ticks: DataFrame, markets: DataFrame, start=None, end=None,
                   stats: DataFrame | None = None) -> DataFrame:
    """One row per (date, market_id): volume, YES prices, spread statistics and
    the time/price correlation, with market metadata (defaults when the market
    has no row in the view)."""
    stats = market_day_stats(ticks, start, end) if stats is None else stats
    view = markets.groupBy("market_id", *VIEW_COLUMNS).agg(F.count(F.lit(1)).alias("_copies"))
    j = stats.join(view, "market_id", "left").withColumn("_copies", F.coalesce("_copies", F.lit(1)))
    # n ticks taken k times each: k * m2 squared deviations of k * n values
    repeated = F.sqrt(F.try_divide(F.col("_copies") * F.col("spread_m2"),
                                   F.col("_copies") * F.col("tick_count") - 1))
    j = j.withColumn("spread_volatility",
                     F.when(F.col("_copies") == 1, F.col("spread_volatility")).otherwise(repeated))
    j = j.withColumn("tick_count", F.col("tick_count") * F.col("_copies"))
    return j.select(
        "date", "market_id",
        F.coalesce("question", F.lit(S.MISSING_QUESTION)).alias("question"),
        F.coalesce("event_title", F.lit(S.MISSING_EVENT_TITLE)).alias("event_title"),
        F.coalesce("category", F.lit(S.MISSING_CATEGORY)).alias("category"),
        F.coalesce("category_slug", F.lit(S.MISSING_SLUG)).alias("category_slug"),
        "end_date", "closed", "resolution_status",
        *HISTORY_COLUMNS[9:],
    )


def category_activity(ticks: DataFrame, markets: DataFrame, start=None, end=None,
                      stats: DataFrame | None = None) -> DataFrame:
    """Per (date, category): active markets, ticks and tick-weighted mean
    spread. Markets missing from the view count under 'Unknown / Deleted'; a
    NULL market id counts as no market."""
    stats = market_day_stats(ticks, start, end) if stats is None else stats
    j = stats.select("date", "market_id", "tick_count", "spread_sum").join(
        markets.select("market_id", "category"), "market_id", "left")
    agg = j.groupBy(
        "date", F.coalesce("category", F.lit(S.MISSING_CATEGORY)).alias("category")
    ).agg(
        F.count_distinct("market_id").alias("market_count"),
        F.sum("tick_count").alias("tick_count"),
        F.sum("spread_sum").alias("_spread_sum"),
    )
    return agg.select("date", "category", "market_count", "tick_count",
                      (F.col("_spread_sum") / F.col("tick_count")).alias("avg_spread"))


SKETCH_BITS = 12          # of the register index: about 1.6 % standard error beyond some thousand ids


def category_market_sketches(stats: DataFrame, markets: DataFrame) -> DataFrame:
    """Per (date, category): the exact number of markets, and a sketch of
    their ids that can be merged with other days' (``distinct_markets``).
    ``stats`` are market-days."""
    j = stats.select("date", "market_id").join(markets.select("market_id", "category"), "market_id", "left")
    return j.groupBy("date", F.coalesce("category", F.lit(S.MISSING_CATEGORY)).alias("category")).agg(
        F.count_distinct("market_id").alias("market_count"),
        F.hll_sketch_agg("market_id", F.lit(SKETCH_BITS)).alias("market_sketch"))


def distinct_markets(sketches: DataFrame, start=None, end=None) -> DataFrame:
    """Per category the distinct markets of any range of dates, approximately,
    from one small sketch per date: neither ticks nor market-days are read."""
    return sketches.where(in_window("date", start, end)).groupBy("category").agg(
        F.hll_sketch_estimate(F.hll_union_agg("market_sketch")).alias("market_estimate"))


def spread_over_time(ticks: DataFrame, start=None, end=None) -> DataFrame:
    """Per (date, hour): YES mean prices, mean and sample stddev of the spread,
    tick count. At most 24 rows a day."""
    t = ticks.where(F.col("best_bid").isNotNull() & F.col("best_ask").isNotNull()
                    & (F.col("spread") >= 0) & in_window("date", start, end))
    return t.groupBy(
        "date", F.date_trunc("HOUR", F.col("timestamp_received")).alias("hour")
    ).agg(
        F.avg(yes_only("best_bid")).alias("yes_avg_bid"),
        F.avg(yes_only("best_ask")).alias("yes_avg_ask"),
        F.avg("spread").alias("avg_spread"),
        F.stddev_samp("spread").alias("stddev_spread"),
        F.count(F.lit(1)).alias("tick_count"),
    )


def spread_distribution(ticks: DataFrame, start=None, end=None) -> DataFrame:
    """Per (date, spread tier): tick count; spreads outside [0, 1] are left
    out. Tier bounds are inclusive (<= 0.02, <= 0.05) whatever the labels say."""
    t = ticks.where((F.col("spread") >= 0) & (F.col("spread") <= 1) & in_window("date", start, end))
    return t.groupBy("date", spread_tier("spread").alias("spread_tier")).agg(
        F.count(F.lit(1)).alias("tick_count"))


def expiry_buckets(history: DataFrame, start=None, end=None) -> DataFrame:
    """Per (date, time-to-expiry bucket) over market-days with an end date.
    Averages are per market (market-weighted), not per tick."""
    h = history.where(F.col("end_date").isNotNull() & in_window("date", start, end))
    h = h.withColumn("_days", days_to_expiry("end_date", "date"))
    return h.groupBy(
        "date",
        expiry_bucket("_days").alias("expiry_bucket"),
        expiry_bucket_order("_days").alias("expiry_bucket_order"),
    ).agg(
        F.count(F.lit(1)).alias("market_count"),
        F.sum("tick_count").alias("total_tick_count"),
        F.avg("tick_count").alias("avg_market_tick_count"),
        F.avg("avg_spread").alias("avg_spread"),
        F.avg("spread_volatility").alias("avg_spread_volatility"),
        F.avg("_days").alias("avg_days_to_expiry"),
    )


def category_concentration(history: DataFrame, activity: DataFrame | None = None, start=None,
                           end=None, with_share_sum: bool = False) -> DataFrame:
    """Per (date, category, market): tick share, rank, and the category-day's
    top share, top-3 share and Herfindahl index repeated on every row.

    Category totals come from ``activity``; without it they are summed over
    the same history rows, which is what the activity fact holds, and the
    ticks behind an unwritten history are read once.

    Input rows are market-days (already aggregated). No task holds a whole
    category-day: ranks are put together from ranges (``ranking``), the other
    statistics are sums and maxima per category-day, combined before they are
    shuffled, and joined back. ``_share_sum`` of ``with_share_sum`` is the sum
    of a category-day's shares, for the rule that checks it.
    """
    group, order = ["date", "category"], [F.desc("market_tick_count"), F.asc("market_id")]
    base = history.where(in_window("date", start, end)).select(
        "date", "category", "market_id", "question",
        F.col("tick_count").alias("market_tick_count"), "avg_spread", "spread_volatility")
    dealt = ranking.deal(base, group, order)
    totals = dealt.groupBy(*group).agg(F.count(F.lit(1)).alias("active_markets"),
                                       F.sum("market_tick_count").alias("category_tick_count"),
                                       F.max("market_tick_count").alias("_top"))
    if activity is not None:
        c = activity.where(in_window("date", start, end) & (F.col("tick_count") > 0)).select(
            *group, F.col("tick_count").alias("category_tick_count"))
        totals = totals.drop("category_tick_count").join(c, group, "inner")
    share = safe_divide("market_tick_count", "category_tick_count")
    ranked = ranking.join_groups(ranking.rank(dealt, group, order, "market_rank_in_category"), totals, group)
    ranked = ranked.withColumn("market_tick_share", share)
    sums = ranking.join_groups(dealt, totals, group).withColumn("_share", share).groupBy(*group).agg(
        F.sum(F.pow("_share", F.lit(2))).alias("hhi_concentration_index"), F.sum("_share").alias("_share_sum"))
    top = ranked.where("market_rank_in_category <= 3").groupBy(*group).agg(
        F.sum("market_tick_share").alias("top_3_market_share"))
    out = ranking.join_groups(ranking.join_groups(ranked, sums, group), top, group)
    return out.select(
        "date", "category", "market_id", "question", "market_tick_count", "category_tick_count",
        "active_markets", "market_tick_share", "market_rank_in_category", "avg_spread",
        "spread_volatility", safe_divide("_top", "category_tick_count").alias("top_market_share"),
        "top_3_market_share", "hhi_concentration_index", *["_share_sum"] * with_share_sum)
