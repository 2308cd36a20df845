"""The plan rewrites equal the direct formulation on random ticks:
aggregate-then-join history = join-then-aggregate over 9 keys; activity
roll-up = COUNT(DISTINCT) over ticks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from compare import _canon
from tickstat import schemas as S
from tickstat.operators import markets as M
from tickstat.operators import reports as R


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_canon(r[c], 9) for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rewrites_equal_direct_form(spark, seed):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    ticks = []
    for _ in range(400):
        bid = rnd.randint(0, 900) / 1000
        ask = bid + rnd.randint(0, 60) / 1000
        ticks.append((base + dt.timedelta(seconds=rnd.randint(0, 3 * 86400)), f"m{rnd.randint(0, 25)}", "t",
                      rnd.choice(["YES", "NO"]), bid, ask, ask - bid, 1.0, "BUY", None))
    t = spark.createDataFrame(ticks, S.PRICE_CHANGES).withColumn("date", F.to_date("timestamp_received"))
    dims = [(f"m{i}", f"q{i}", "e", rnd.choice(["A", "B", None]), None, rnd.choice([None, "2024-01-05"]),
             rnd.choice([True, False]), None, i % 7 == 0) for i in range(0, 25, 2)]
    view = M.markets_view(spark.createDataFrame(dims, S.DIM_MARKETS))

    j = t.where(F.col("spread") >= 0).join(view, "market_id", "left")
    yes = lambda c: F.when(F.col("side") == "YES", F.col(c))
    direct_hist = j.groupBy("date", "market_id", "question", "event_title", "category", "category_slug",
                            "end_date", "closed", "resolution_status").agg(
        F.count(F.lit(1)).alias("tick_count"), F.avg(yes("best_bid")).alias("yes_avg_bid"),
        F.avg(yes("best_ask")).alias("yes_avg_ask"), F.min(yes("best_bid")).alias("yes_min_bid"),
        F.max(yes("best_ask")).alias("yes_max_ask"), F.avg("spread").alias("avg_spread"),
        F.stddev_samp("spread").alias("spread_volatility"), F.min("spread").alias("min_spread"),
        F.max("spread").alias("max_spread"))
    direct_hist = direct_hist.select(
        "date", "market_id",
        F.coalesce("question", F.lit(S.MISSING_QUESTION)).alias("question"),
        F.coalesce("event_title", F.lit(S.MISSING_EVENT_TITLE)).alias("event_title"),
        F.coalesce("category", F.lit(S.MISSING_CATEGORY)).alias("category"),
        F.coalesce("category_slug", F.lit(S.MISSING_SLUG)).alias("category_slug"),
        *[c for c in direct_hist.columns if c not in ("date", "market_id", "question", "event_title",
                                                       "category", "category_slug")])
    ours = R.market_history(t, view).drop("price_trend_corr")
    assert rows(ours) == rows(direct_hist.select(*ours.columns))

    direct_act = j.groupBy("date", F.coalesce("category", F.lit(S.MISSING_CATEGORY)).alias("category")).agg(
        F.count_distinct("market_id").alias("market_count"), F.count(F.lit(1)).alias("tick_count"),
        F.avg("spread").alias("avg_spread"))
    assert rows(R.category_activity(t, view)) == rows(direct_act)
