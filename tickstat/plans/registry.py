"""Named queries over the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from the
given parquet tables through the fixture projections in
``sources.fixtures``. Whole tables, no sampling; the ``*_window`` queries apply
the reports' own half-open date window. ``present`` aligns output types with the SQL oracle (doubles rounded
to 9 places because sums are order dependent; UTC timestamps as wall-clock
TIMESTAMP_NTZ, the type the oracle returns).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import markets as M
from ..operators import reports as R
from ..operators import ticks as K
from ..sources import fixtures as FX
from ..session import configure, delete_at_exit, materialize, scratch_path
from ..sources.tables import read_table

ROUND_DIGITS = 9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def present(df: DataFrame) -> DataFrame:
    """Doubles rounded, UTC timestamps as wall-clock NTZ (one projection)."""
    exprs = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if isinstance(f.dataType, T.DoubleType):
            # + 0.0 turns a rounded -0.0 into 0.0 (engines differ on its sign)
            exprs.append(f"round({name}, {ROUND_DIGITS}) + 0.0 AS {name}")
        elif isinstance(f.dataType, T.TimestampType):
            exprs.append(f"CAST({name} AS TIMESTAMP_NTZ) AS {name}")
        else:
            exprs.append(name)
    return df.selectExpr(*exprs)


# ----------------------------------------------------------------- inputs
def orderbook(spark, sf_dir):
    return FX.orderbook_from_events(table(spark, sf_dir, "events"))


def ticks(spark, sf_dir):
    return K.price_changes(orderbook(spark, sf_dir))


def dim(spark, sf_dir):
    return FX.dim_from_customer(table(spark, sf_dir, "customer"))


def markets(spark, sf_dir):
    return M.markets_view(dim(spark, sf_dir))


def _stats(spark, sf_dir):
    return R.market_day_stats(ticks(spark, sf_dir))


def history(spark, sf_dir, stats=None):
    stats = _stats(spark, sf_dir) if stats is None else stats
    return R.market_history(None, markets(spark, sf_dir), stats=stats)


def activity(spark, sf_dir, stats=None):
    stats = _stats(spark, sf_dir) if stats is None else stats
    return R.category_activity(None, markets(spark, sf_dir), stats=stats)


# ---------------------------------------------------------------- queries
def q_price_changes(spark, sf_dir):
    return ticks(spark, sf_dir)


def q_reject_report(spark, sf_dir):
    return K.reject_report(orderbook(spark, sf_dir))


def q_markets_view(spark, sf_dir):
    return markets(spark, sf_dir)


def q_category_activity(spark, sf_dir):
    return activity(spark, sf_dir)


def q_market_history(spark, sf_dir):
    return history(spark, sf_dir)


def q_spread_over_time(spark, sf_dir):
    return R.spread_over_time(ticks(spark, sf_dir))


def q_spread_distribution(spark, sf_dir):
    return R.spread_distribution(ticks(spark, sf_dir))


def q_expiry_buckets(spark, sf_dir):
    return R.expiry_buckets(history(spark, sf_dir))


def q_category_concentration(spark, sf_dir):
    return concentration(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "price_changes": q_price_changes,
    "reject_report": q_reject_report,
    "markets_view": q_markets_view,
    "category_activity": q_category_activity,
    "market_history": q_market_history,
    "spread_over_time": q_spread_over_time,
    "spread_distribution": q_spread_distribution,
    "expiry_buckets": q_expiry_buckets,
    "category_concentration": q_category_concentration,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Registered queries; each applies the session settings (UTC, ANSI, ...)
    to the caller's session before building its plan."""
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return present(fn(spark, sf_dir))
        return run
    return {name: wrap(fn) for name, fn in QUERIES.items()}


# ----------------------------------------------------------- quality rules
from ..operators import quality as Q  # noqa: E402


def over_time(spark, sf_dir):
    return R.spread_over_time(ticks(spark, sf_dir))


def distribution(spark, sf_dir):
    return R.spread_distribution(ticks(spark, sf_dir))


def concentration(spark, sf_dir):
    # category totals from the same history rows: the ticks are parsed once
    return R.category_concentration(history(spark, sf_dir))


# the quality queries check rows of which some are bad (see the fixtures), so
# that every kind of rule has violations to find
def q_quality_orderbook(spark, sf_dir):
    return Q.quality_report(FX.spoiled_orderbook(orderbook(spark, sf_dir)), Q.orderbook_rules(),
                            table="orderbook")


def q_quality_ticks(spark, sf_dir):
    return Q.quality_report(FX.spoiled_ticks(ticks(spark, sf_dir)), Q.ticks_rules(), table="price_changes")


def q_quality_markets(spark, sf_dir):
    bad = FX.spoiled_dim(dim(spark, sf_dir))
    return Q.quality_report(bad, Q.dim_rules(), table="dim_markets").unionByName(
        Q.quality_report(M.markets_view(bad), Q.view_rules(), table="markets_view"))


def q_quality_facts(spark, sf_dir):
    # the payload is parsed once; what several facts or several passes of the
    # rules read is written for them
    seen, view = materialize(ticks(spark, sf_dir), "ticks"), markets(spark, sf_dir)
    stats = materialize(R.market_day_stats(seen), "market_day_stats")
    hist = materialize(R.market_history(None, view, stats=stats), "history")
    facts = {
        "category_activity": (R.category_activity(None, view, stats=stats), Q.activity_rules()),
        "market_history": (hist, Q.history_rules()),
        "spread_over_time": (R.spread_over_time(seen), Q.over_time_rules()),
        "spread_distribution": (materialize(R.spread_distribution(seen), "distribution"), Q.distribution_rules()),
        "expiry_buckets": (materialize(R.expiry_buckets(hist), "expiry"), Q.expiry_rules()),
        "category_concentration": (materialize(R.category_concentration(hist), "concentration"), Q.concentration_rules()),
    }
    return reduce(DataFrame.unionByName, [
        Q.quality_report(FX.spoiled_fact(df, name), rules, table=name) for name, (df, rules) in facts.items()])


def q_ghost_ratio(spark, sf_dir):
    d = dim(spark, sf_dir)
    ratio = F.try_divide(F.count_if(F.col("is_ghost") == F.lit(True)), F.count(F.lit(1)))
    return d.agg(F.count(F.lit(1)).alias("markets"),
                 F.count_if(F.col("is_ghost") == F.lit(True)).alias("ghosts"),
                 ratio.alias("ghost_ratio"),
                 (ratio > 0.10).alias("above_limit"))


def q_share_sum_check(spark, sf_dir):
    c = concentration(spark, sf_dir)
    return c.groupBy("date", "category").agg(
        F.abs(F.sum("market_tick_share") - F.lit(1.0)).alias("share_gap")
    ).withColumn("within_tolerance", F.col("share_gap") <= F.lit(1e-4))


QUERIES.update({
    "quality_orderbook": q_quality_orderbook,
    "quality_ticks": q_quality_ticks,
    "quality_markets": q_quality_markets,
    "quality_facts": q_quality_facts,
    "ghost_ratio": q_ghost_ratio,
    "share_sum_check": q_share_sum_check,
})


# ------------------------------------------- sources, sinks and enrichment
from ..functions.category import pick_category  # noqa: E402
from .. import schemas as S  # noqa: E402
from ..functions.columns import in_window, written_date  # noqa: E402
from ..functions.text import sanitize_text  # noqa: E402
from ..operators import sinks as SK  # noqa: E402
from ..sources import raw as RAW  # noqa: E402
from ..sources.payload import parse_market_payload, split_payload  # noqa: E402

# Fixed values of the replace and merge fixtures.
REPLACE_WINDOW = ("2024-01-10", "2024-01-20")
REPLACE_EMPTIED = "2024-01-15"


def q_partition_row_counts(spark, sf_dir):
    return RAW.partition_row_counts(orderbook(spark, sf_dir))


def _expected_slots(spark, sf_dir):
    return RAW.hour_slots_between(RAW.data_hour_bounds(orderbook(spark, sf_dir)))


def q_hour_slots(spark, sf_dir):
    return _expected_slots(spark, sf_dir)


def q_date_slots(spark, sf_dir):
    return RAW.date_slots_between(RAW.data_hour_bounds(orderbook(spark, sf_dir)))


def _landed(spark, sf_dir):
    return RAW.landed_slots_from_data(FX.landed_late(orderbook(spark, sf_dir)))


def q_missing_slots(spark, sf_dir):
    return RAW.missing_slots(_expected_slots(spark, sf_dir), _landed(spark, sf_dir))


def q_slot_completeness(spark, sf_dir):
    return RAW.completeness(RAW.slot_status(_expected_slots(spark, sf_dir), _landed(spark, sf_dir)))


def q_window_replace(spark, sf_dir):
    act = activity(spark, sf_dir)
    existing = act.withColumn("version", F.lit("old"))
    fresh = act.where(in_window("date", *REPLACE_WINDOW)
                      & (F.col("date") != F.lit(REPLACE_EMPTIED).cast("date"))) \
        .withColumn("version", F.lit("new"))
    return SK.window_replace(existing, fresh, *REPLACE_WINDOW)


def merge_fixture(spark, sf_dir):
    """Target: dimension rows with key % 3 = 0. Source: the other rows, plus
    changed copies of target rows with key % 5 = 0 (must not update) and a
    second, different row for key 1 (a duplicate source key)."""
    d = dim(spark, sf_dir).withColumn("_k", FX.market_key())
    target = d.where(F.col("_k") % 3 == 0).drop("_k")
    changed = d.where((F.col("_k") % 3 == 0) & (F.col("_k") % 5 == 0)) \
        .withColumn("question", F.lit("changed")).drop("_k")
    dup = d.where(F.col("_k") == 1) \
        .withColumn("question", F.concat("question", F.lit(" (dup)"))).drop("_k")
    source = d.where(F.col("_k") % 3 != 0).drop("_k").unionByName(changed).unionByName(dup)
    return target, source


def q_insert_only_merge(spark, sf_dir):
    target, source = merge_fixture(spark, sf_dir)
    return SK.insert_only_merge(target, source, "market_id")


def q_merge_one_per_key(spark, sf_dir):
    target, source = merge_fixture(spark, sf_dir)
    return SK.insert_only_merge(target, source, "market_id", dedup=True)


def q_landed_payload(spark, sf_dir):
    """Market objects as landed JSON text, read back with the declared schema."""
    payload = FX.market_payload_from_customer(table(spark, sf_dir, "customer"))
    landed = payload.select(F.to_json(F.struct(*payload.columns)).alias("value"))
    event = F.try_element_at("events", F.lit(1))
    return parse_market_payload(landed).select(
        "conditionId", "question", F.size("events").cast("long").alias("events"), event["id"].alias("event_id"),
        event["title"].alias("event_title"), "endDateIso", "endDate", "closed", "umaResolutionStatus",
        F.schema_of_variant("umaResolutionStatuses").startswith("ARRAY").alias("statuses_are_a_list"))


def q_new_market_ids(spark, sf_dir):
    return M.new_market_ids(orderbook(spark, sf_dir), dim(spark, sf_dir))


def q_pick_category(spark, sf_dir):
    tagged = FX.market_tags_from_customer(table(spark, sf_dir, "customer"))
    picked = pick_category(F.col("tags"))
    return tagged.select("market_id", picked["category"].alias("category"),
                         picked["category_slug"].alias("category_slug"))


def q_sanitize_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", sanitize_text("text").alias("text"))


def q_ghost_fill(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    target = dim(spark, sf_dir).where(FX.market_key() % 3 == 0)
    ids = M.new_market_ids(orderbook(spark, sf_dir), target)
    return M.enrich_markets(ids, FX.market_payload_from_customer(customer),
                            FX.event_tags_from_customer(customer))


QUERIES.update({
    "partition_row_counts": q_partition_row_counts,
    "hour_slots": q_hour_slots,
    "missing_slots": q_missing_slots,
    "slot_completeness": q_slot_completeness,
    "window_replace": q_window_replace,
    "insert_only_merge": q_insert_only_merge,
    "merge_one_per_key": q_merge_one_per_key,
    "date_slots": q_date_slots,
    "landed_payload": q_landed_payload,
    "new_market_ids": q_new_market_ids,
    "pick_category": q_pick_category,
    "sanitize_text": q_sanitize_text,
    "ghost_fill": q_ghost_fill,
})


# --------------------------------------------- tables: written and read back
def _landed_table(spark, sf_dir, late=False):
    """The order book as a date-partitioned table of the shared folder, and
    its path. Every call writes one of its own; the driver's end deletes it."""
    path = scratch_path(spark, "raw_orderbook")
    ob = orderbook(spark, sf_dir)
    ob = FX.landed_late(ob) if late else ob
    SK.overwrite_partitions(ob.withColumn("date", F.to_date("timestamp_received")), path,
                            cluster_by=["market_id", "update_type"])
    delete_at_exit(spark, path)
    return path


def q_raw_scan_window(spark, sf_dir):
    return RAW.scan_raw(spark, _landed_table(spark, sf_dir), *WINDOW)


def q_overwritten_dates(spark, sf_dir):
    """Two dates overwritten by the rows of even keys; rows per date after it."""
    path = _landed_table(spark, sf_dir)
    fresh = orderbook(spark, sf_dir).withColumn("date", F.to_date("timestamp_received")).where(FX.market_key() % 2 == 0)
    SK.overwrite_dates(fresh, path, *OVERWRITE_WINDOW, cluster_by=["market_id", "update_type"])
    return RAW.partition_row_counts(RAW.scan_raw(spark, path))


def q_window_replace_table(spark, sf_dir):
    """``window_replace`` on a table: a first run over all dates, then a run
    of the window; both as in the daily job."""
    act, path = materialize(activity(spark, sf_dir), "activity"), scratch_path(spark, "activity_table")
    SK.write_window(act.withColumn("version", F.lit("old")), path, "2024-01-01", "2024-02-01", ["category"], large=False)
    fresh = act.where(in_window("date", *REPLACE_WINDOW) & (F.col("date") != F.lit(REPLACE_EMPTIED).cast("date")))
    SK.write_window(fresh.withColumn("version", F.lit("new")), path, *REPLACE_WINDOW, ["category"], large=False)
    delete_at_exit(spark, path)
    return spark.read.parquet(path).select(*act.columns, "version")


def q_missing_slots_by_path(spark, sf_dir):
    """Hours without a landed file: the order book is landed in folders named
    by the hour, and the slots come from the scan's file paths."""
    path, late = scratch_path(spark, "landed_hours"), FX.landed_late(orderbook(spark, sf_dir))
    (late.withColumns({"date": F.to_date("timestamp_received"), "slot": F.date_format("timestamp_received", S.HOUR_SLOT_FORMAT)})
     .repartition("date").write.partitionBy("date", "slot").parquet(path))
    delete_at_exit(spark, path)
    files = RAW.landed_files(spark.read.schema(S.RAW_ORDERBOOK).parquet(path))
    return RAW.missing_slots(_expected_slots(spark, sf_dir), RAW.landed_slots_from_paths(files))


def q_quarantined_payload(spark, sf_dir):
    """Landed lines of which some are cut off or no objects: one row per line."""
    lines = FX.landed_lines_from_customer(table(spark, sf_dir, "customer"))
    parsed = parse_market_payload(lines, quarantine=True)
    good, bad = split_payload(parsed)
    return good.select("conditionId", F.lit(None).cast("long").alias("quarantined_chars")).unionByName(
        bad.select(F.lit(None).cast("string").alias("conditionId"),
                   F.char_length("line").cast("long").alias("quarantined_chars")))


def q_quality_payload(spark, sf_dir):
    lines = FX.landed_lines_from_customer(table(spark, sf_dir, "customer"))
    return Q.quality_report(parse_market_payload(lines, quarantine=True), Q.payload_rules(), table="market_payload")


def q_end_dates(spark, sf_dir):
    """End dates written in many ways."""
    return FX.dated_texts_from_customer(table(spark, sf_dir, "customer")).select(
        "market_id", "text", written_date("text").alias("end_date"))


def q_distinct_markets_range(spark, sf_dir):
    """Distinct markets per category over all dates, and whether the merged
    sketches come within 5 % of them."""
    stats, view = materialize(_stats(spark, sf_dir), "market_day_stats"), markets(spark, sf_dir)
    sketches = R.category_market_sketches(stats, view)
    exact = (stats.join(view.select("market_id", "category"), "market_id", "left")
             .groupBy(F.coalesce("category", F.lit(S.MISSING_CATEGORY)).alias("category"))
             .agg(F.count_distinct("market_id").alias("market_count")))
    return exact.join(R.distinct_markets(sketches), "category").select(
        "category", "market_count",
        (F.abs(F.col("market_estimate") - F.col("market_count")) <= 0.05 * F.col("market_count")).alias("estimate_is_near"))


OVERWRITE_WINDOW = ("2024-01-09", "2024-01-11")

QUERIES.update({
    "raw_scan_window": q_raw_scan_window,
    "overwritten_dates": q_overwritten_dates,
    "window_replace_table": q_window_replace_table,
    "missing_slots_by_path": q_missing_slots_by_path,
    "quarantined_payload": q_quarantined_payload,
    "quality_payload": q_quality_payload,
    "end_dates": q_end_dates,
    "distinct_markets_range": q_distinct_markets_range,
    "category_concentration_joined": lambda s, d: R.category_concentration(
        *(materialize(f, "fact") for f in (history(s, d), activity(s, d)))),
})


# ------------------------------------------------------------------- tiles
from ..operators import tiles as DT  # noqa: E402

# Fixed values of the filtered tiles.
TILE_CATEGORY = "MACHINERY"
TILE_QUESTION = "Customer#000000001"

QUERIES.update({
    "daily_ticks": lambda s, d: DT.daily_ticks(activity(s, d)),
    "category_daily_ticks": lambda s, d: DT.category_daily_ticks(activity(s, d), TILE_CATEGORY),
    "category_share": lambda s, d: DT.category_share(activity(s, d)),
    "spread_heartbeat": lambda s, d: DT.spread_heartbeat(over_time(s, d)),
    "tier_share": lambda s, d: DT.tier_share(distribution(s, d)),
    "market_lifecycle": lambda s, d: DT.market_lifecycle(history(s, d), TILE_QUESTION),
    "expiry_segmentation": lambda s, d: DT.expiry_segmentation(R.expiry_buckets(history(s, d))),
    "concentration_heatmap": lambda s, d: DT.concentration_heatmap(concentration(s, d)),
    "category_pie": lambda s, d: DT.category_pie(activity(s, d)),
    "market_share_drilldown": lambda s, d: DT.market_share_drilldown(concentration(s, d), TILE_CATEGORY),
})


# ----------------------------------------------------------- date windows
WINDOW = ("2024-01-08", "2024-01-15")

QUERIES.update({
    "market_history_window": lambda s, d: R.market_history(ticks(s, d), markets(s, d), *WINDOW),
    "category_activity_window": lambda s, d: R.category_activity(ticks(s, d), markets(s, d), *WINDOW),
    "spread_over_time_window": lambda s, d: R.spread_over_time(ticks(s, d), *WINDOW),
    "spread_distribution_window": lambda s, d: R.spread_distribution(ticks(s, d), *WINDOW),
    "expiry_buckets_window": lambda s, d: R.expiry_buckets(history(s, d), *WINDOW),
    "category_concentration_window": lambda s, d: R.category_concentration(
        history(s, d), activity(s, d), *WINDOW),
    "price_changes_window": lambda s, d: K.price_changes(orderbook(s, d), *WINDOW),
    "new_market_ids_window": lambda s, d: M.new_market_ids(orderbook(s, d), dim(s, d), *WINDOW),
    "partition_row_counts_window": lambda s, d: RAW.partition_row_counts(orderbook(s, d), *WINDOW),
})


# -------------------------------------------------- repeated dimension rows
def doubled_markets(spark, sf_dir):
    """The view with the rows of keys % 4 = 0 twice, for keys % 8 = 0 with
    another question: what a merge of duplicate keys leads to."""
    view = markets(spark, sf_dir)
    key = FX.market_key()
    again = F.when(key % 8 == 0, F.concat("question", F.lit(" (dup)"))).otherwise(F.col("question"))
    both = F.when(key % 4 == 0, F.array(F.col("question"), again)).otherwise(F.array("question"))
    return view.withColumn("question", F.explode(both)).select(*view.columns)


def unnamed_ticks(spark, sf_dir):
    """The ticks with no id for markets with key % 23 = 0."""
    return ticks(spark, sf_dir).withColumn("market_id", F.when(FX.market_key() % 23 != 0, F.col("market_id")))


QUERIES.update({
    "market_history_repeated": lambda s, d: R.market_history(unnamed_ticks(s, d), doubled_markets(s, d)),
    "category_activity_repeated": lambda s, d: R.category_activity(unnamed_ticks(s, d), doubled_markets(s, d)),
})
