"""Measure the direct (source-shaped) form of three steps against the
library's rewrites, on a raw table landed from the driver's ``events`` table
(rows replicated REPLICAS times with distinct event ids). Writes
docs/REWRITES.md. The direct forms exist only here, as baselines.
"""

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from pyspark.sql import functions as F  # noqa: E402

from tickstat import schemas as S  # noqa: E402
from tickstat.operators import markets as M, reports as R, ticks as K  # noqa: E402
from tickstat.operators import sinks as SK  # noqa: E402
from tickstat.plans import registry as G  # noqa: E402
from tickstat.session import local_session  # noqa: E402
from tickstat.sources import fixtures as FX  # noqa: E402

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.1")
REPLICAS = int(os.environ.get("REPLICAS", "20"))


def best(df, reps=3):
    out = []
    for _ in range(reps):
        t = time.time()
        df.write.format("noop").mode("overwrite").save()
        out.append(time.time() - t)
    return min(out)


def direct_ticks(ob):
    """The source's shape: one JSON_VALUE call per use (15 in the query)."""
    j = lambda k: F.get_json_object("data", f"$.{k}")
    num = lambda k: j(k).try_cast("double")
    w = ob.where(F.col("update_type") == "price_change") \
        .where(j("best_bid").isNotNull() & j("best_ask").isNotNull() & j("side").isin("YES", "NO")
               & num("best_bid").between(0.0, 1.0) & num("best_ask").between(0.0, 1.0)
               & (num("best_ask") >= num("best_bid")))
    return w.select("timestamp_received", "market_id", j("token_id").alias("token_id"),
                    j("side").alias("side"), num("best_bid").alias("best_bid"),
                    num("best_ask").alias("best_ask"), (num("best_ask") - num("best_bid")).alias("spread"),
                    num("change_size").alias("change_size"), j("change_side").alias("change_side"),
                    F.to_date("timestamp_received").alias("date"))


def direct_history(ticks, view):
    j = ticks.where(F.col("spread") >= 0).join(view, "market_id", "left")
    yes = lambda c: F.when(F.col("side") == "YES", F.col(c))
    return j.groupBy("date", "market_id", "question", "event_title", "category", "category_slug",
                     "end_date", "closed", "resolution_status").agg(
        F.count(F.lit(1)).alias("tick_count"), F.avg(yes("best_bid")), F.avg(yes("best_ask")),
        F.min(yes("best_bid")), F.max(yes("best_ask")), F.avg("spread"), F.stddev_samp("spread"),
        F.min("spread"), F.max("spread"))


def direct_activity(ticks, view):
    j = ticks.where(F.col("spread") >= 0).join(view, "market_id", "left")
    return j.groupBy("date", F.coalesce("category", F.lit(S.MISSING_CATEGORY))).agg(
        F.count_distinct("market_id"), F.count(F.lit(1)), F.avg("spread"))


def main():
    scratch = tempfile.mkdtemp(prefix="tickstat-rewrites-")
    spark = local_session(8, shuffle_partitions=16, checkpoint=f"{scratch}/ck")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    big = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(REPLICAS - 1))).alias("r")) \
        .withColumn("event_id", F.col("event_id") * REPLICAS + F.col("r")).drop("r")
    ob = FX.orderbook_from_events(big).withColumn("date", F.to_date("timestamp_received"))
    SK.overwrite_partitions(ob, f"{scratch}/raw", cluster_by=["market_id", "update_type"])
    raw = spark.read.parquet(f"{scratch}/raw")
    n_raw = raw.count()
    K.price_changes(raw).write.parquet(f"{scratch}/ticks")
    ticks = spark.read.parquet(f"{scratch}/ticks")
    n_ticks = ticks.count()
    view = M.markets_view(G.dim(spark, SF))

    rows = [
        ("raw -> ticks", "15 get_json_object calls (one per use)", best(direct_ticks(raw)),
         "one json_tuple per row", best(K.price_changes(raw))),
        ("market history", "join every tick, group by 9 keys", best(direct_history(ticks, view)),
         "group by (date, market), then join", best(R.market_history(ticks, view))),
        ("category activity", "join every tick, COUNT(DISTINCT)", best(direct_activity(ticks, view)),
         "roll-up of the market-day aggregate", best(R.category_activity(ticks, view))),
    ]
    lines = ["# Direct form vs rewrite", "",
             f"`scripts/compare_rewrites.py`: {n_raw:,} raw rows ({SF.rsplit('/', 1)[-1]} events x "
             f"{REPLICAS}, distinct event ids), {n_ticks:,} ticks, local[8], noop sink, best of 3.", "",
             "| step | direct form | sec | rewrite | sec | speed-up |", "|---|---|---|---|---|---|"]
    for step, d, td, r, tr in rows:
        lines.append(f"| {step} | {d} | {td:.2f} | {r} | {tr:.2f} | {td / tr:.1f}x |")
    text = "\n".join(lines) + "\n"
    with open(os.path.join(os.path.dirname(__file__), "..", "docs", "REWRITES.md"), "w") as f:
        f.write(text)
    print(text)
    spark.stop()


if __name__ == "__main__":
    main()
