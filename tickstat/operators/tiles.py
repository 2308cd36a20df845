"""Dashboard tile queries over the fact tables.

They read facts (one row per date x category / hour / tier / market), never
ticks, so every window below partitions a handful of rows: share-of-day
windows are bounded by the categories or tiers of one date, and the range
share by the number of categories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_ticks(activity: DataFrame) -> DataFrame:
    """Total ticks per day over all categories."""
    return activity.groupBy("date").agg(F.sum("tick_count").alias("tick_count"))


def category_daily_ticks(activity: DataFrame, category: str) -> DataFrame:
    """Ticks per day of one category (the category filter of the tile)."""
    return activity.where(F.col("category") == F.lit(category)) \
        .groupBy("date").agg(F.sum("tick_count").alias("tick_count"))


def _share_of_day(df: DataFrame, key: str) -> DataFrame:
    day = Window.partitionBy("date")
    return df.select("date", key, "tick_count",
                     (F.col("tick_count") / F.sum("tick_count").over(day)).alias("tick_share"))


def category_share(activity: DataFrame) -> DataFrame:
    """Each category's share of the day's ticks (100 % stacked)."""
    return _share_of_day(activity, "category")


def spread_heartbeat(over_time: DataFrame) -> DataFrame:
    """Mean spread and tick count by hour."""
    return over_time.select("date", "hour", "avg_spread", "tick_count")


def tier_share(distribution: DataFrame) -> DataFrame:
    """Each spread tier's share of the day's ticks (100 % stacked)."""
    return _share_of_day(distribution, "spread_tier")


def market_lifecycle(history: DataFrame, question: str) -> DataFrame:
    """One market's YES mean bid and tick count per day, chosen by question."""
    return history.where(F.col("question") == F.lit(question)) \
        .select("date", "market_id", "question", "yes_avg_bid", "tick_count")


def expiry_segmentation(expiry: DataFrame) -> DataFrame:
    """Markets and ticks per time-to-expiry bucket over the whole range."""
    return expiry.groupBy("expiry_bucket", "expiry_bucket_order").agg(
        F.sum("market_count").alias("market_days"),
        F.sum("total_tick_count").alias("tick_count"))


def concentration_heatmap(concentration: DataFrame) -> DataFrame:
    """One cell per (date, category): the category-day metrics that the
    concentration fact repeats on every market row."""
    return concentration.groupBy("date", "category").agg(
        F.max("active_markets").alias("active_markets"),
        F.max("top_market_share").alias("top_market_share"),
        F.max("top_3_market_share").alias("top_3_market_share"),
        F.max("hhi_concentration_index").alias("hhi_concentration_index"))


def category_pie(activity: DataFrame) -> DataFrame:
    """Each category's share of all ticks in the range."""
    per = activity.groupBy("category").agg(F.sum("tick_count").alias("tick_count"))
    total = activity.agg(F.sum("tick_count")).scalar()        # a single-row subquery
    return per.select("category", "tick_count", (F.col("tick_count") / total).alias("tick_share"))


def market_share_drilldown(concentration: DataFrame, category: str) -> DataFrame:
    """The markets behind one category's cells of the heat-map, with share and
    rank on each day."""
    return concentration.where(F.col("category") == F.lit(category)).select(
        "date", "market_id", "question", "market_tick_count", "market_tick_share",
        "market_rank_in_category")


def segmentation(facts: DataFrame) -> DataFrame:
    """Expiry segmentation for the expiry-bucket fact, the concentration
    heat-map for the concentration fact."""
    if "expiry_bucket" in facts.columns:
        return expiry_segmentation(facts)
    return concentration_heatmap(facts)
