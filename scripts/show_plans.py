"""Write docs/PLANS.md: final (post-AQE) physical plans of the production path.

Lands the fixture order book as a date-partitioned raw table, runs the daily
job once, then executes and explains the main steps over the written tables,
keeping the plan tree and the scan details (partition filters, pushed
filters, read schema).
"""

import io
import os
import re
import sys
import tempfile
from contextlib import redirect_stdout

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from pyspark.sql import functions as F  # noqa: E402

from tickstat.operators import markets as M, quality as Q, reports as R, ticks as K  # noqa: E402
from tickstat.operators import sinks as SK  # noqa: E402
from tickstat.plans import daily, registry as G  # noqa: E402
from tickstat.session import local_session  # noqa: E402
from tickstat.sources import raw as RAW  # noqa: E402

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
START, END = "2024-01-08", "2024-01-15"


def explained(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = [b for b in details.split("\n\n") if re.search(r"Scan parquet|Exchange|BroadcastExchange", b)]
    keep = ["\n".join(ln for ln in b.splitlines()
                      if re.match(r"\(\d+\)|Output|Batched|Location|PartitionFilters|PushedFilters|ReadSchema|Arguments", ln))
            for b in keep]
    return tree.strip() + "\n\n" + "\n\n".join(keep)


def main():
    scratch = tempfile.mkdtemp(prefix="tickstat-plans-")
    spark = local_session(8, shuffle_partitions=16, checkpoint=f"{scratch}/ck")
    ob = G.orderbook(spark, SF).withColumn("date", F.to_date("timestamp_received"))
    SK.overwrite_partitions(ob, f"{scratch}/raw", cluster_by=["market_id", "update_type"])
    dim_path = f"{scratch}/dim"
    G.dim(spark, SF).write.parquet(dim_path)
    dim = spark.read.parquet(dim_path)
    res = daily.run_window(spark, RAW.scan_raw(spark, f"{scratch}/raw", "2024-01-01", "2024-01-31"),
                           dim, f"{scratch}/out", "2024-01-01", "2024-01-31")
    p = res.paths
    raw = RAW.scan_raw(spark, f"{scratch}/raw", START, END)
    ticks = daily.read_window(spark, p["price_changes"], START, END)
    hist = daily.read_window(spark, p["market_history"], START, END)
    act = daily.read_window(spark, p["category_activity"], START, END)
    views = M.markets_view(dim)
    steps = [
        ("raw -> ticks (price_changes), as the daily job runs it",
         "Window and update_type reach the scan; one json_tuple; the ticks' checks are observed above it.",
         Q.observe_rules(K.price_changes(raw, START, END), Q.ticks_rules(), table="price_changes")[0]),
        ("quality_report on the raw table", "A pass of its own without a parse.",
         Q.quality_report(K.window_rows(raw, START, END), Q.orderbook_rules(), table="orderbook")),
        ("market_history from the ticks table",
         "Partial aggregate below the only tick shuffle; dimension joined to market-days.",
         R.market_history(ticks, views, START, END)),
        ("category_activity (roll-up)", "The distinct count runs over market-days.", R.category_activity(ticks, views, START, END)),
        ("spread_over_time", "Hourly groups, partial aggregation.", R.spread_over_time(ticks, START, END)),
        ("category_concentration from the written facts",
         "Ranks inside ranges of (date, category, count, id); sums per category-day joined back. No window holds one.",
         R.category_concentration(hist, act, START, END)),
        ("quality_report on the ticks table", "All row rules in one aggregate.",
         Q.quality_report(ticks, Q.ticks_rules(), table="price_changes")),
        ("quality_report with rules over two sets of keys", "All grouped rules in one pass (Expand), the row rules in another.",
         Q.quality_report(hist, [Q.not_null("market_id"), Q.unique("date", "market_id"),
                                 Q.max_per_group("markets a day", ["date"], 10**6)], table="market_history")),
        ("new_market_ids", "Distinct ids (partial) anti-joined to the dimension ids.",
         M.new_market_ids(raw, dim, START, END)),
    ]
    out = ["# Physical plans (final, after AQE)", "",
           f"Generated by `scripts/show_plans.py` at `{os.path.basename(SF)}`, window "
           f"[{START}, {END}) over tables written by the daily job (`date=` partitioned).", ""]
    for title, note, df in steps:
        out += [f"## {title}", "", note, "", "```", explained(df), "```", ""]
    with open(os.path.join(os.path.dirname(__file__), "..", "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
