"""The daily job: raw order book -> dimension, ticks table -> six fact tables.

One call processes a half-open date window and is idempotent: every table is
written with ``sinks.write_window`` (delete+insert of the window), so re-runs
and backfills replace exactly their dates.

Shape at scale (5e8+ raw rows a day):

* The raw scan is pruned to the window's ``date=`` folders and to the four
  columns used; the JSON payload is parsed once per row; the ticks are written
  clustered by market_id (rebalanced: AQE splits a hot market over tasks).
* Every later step reads the **written** ticks table (columnar, pruned), so
  the JSON is parsed exactly once per run and lineage stops at the table; a
  lost executor only re-runs the current step.
* The three tick scans (market-day stats, hourly, tiers) each reduce
  billions of ticks with map-side partial aggregation to at most a few
  thousand rows per task.
* The per-market-day aggregate is written once as Parquet under the cluster's
  ``spark.checkpoint.dir`` and feeds both the history and the activity fact;
  expiry buckets and concentration read the written history/activity facts.
* The rules of the ticks and of every fact are observed metrics of the pass
  that writes them: no table is scanned only to be checked. The raw table's
  rules are a pass of their own that does not parse: of the payload it needs
  only whether it is there, and it keeps no filter from the scan that does
  parse (an observation above that scan would). ``gate`` raises on a blocking
  failure after all tables are written (as the source checks after
  materialization).
* With ``catalog`` the tables are catalog tables whose dates are replaced by
  pointing them at new folders (``operators.catalog``), else folders that are
  moved (``sinks.write_window``).
* ``update_dimension`` discovers the window's unknown market ids, enriches
  them and checks what the dimension would be with them before it appends
  them; ``run_daily`` does that first, so a blocking rule of the dimension or
  the view stops the run before anything is written.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import in_window
from ..operators import catalog as C
from ..operators import markets as M
from ..operators import quality as Q
from ..operators import reports as R
from ..operators import sinks as SK
from ..operators import ticks as K
from ..session import materialize, scratch_path
from ..sources.payload import CORRUPT, split_payload
from ..sources.raw import scan_raw

TABLES = ("price_changes", "market_history", "category_activity", "spread_over_time",
          "spread_distribution", "expiry_buckets", "category_concentration")

# cluster keys per table (Parquet min/max pruning inside each date folder)
CLUSTER = {
    "price_changes": (["market_id"], "timestamp_received"),
    "market_history": (["category", "market_id"], None),
    "category_activity": (["category"], None),
    "spread_over_time": (["hour"], None),
    "spread_distribution": ([], None),
    "expiry_buckets": ([], None),
    "category_concentration": (["category", "market_id"], None),
}

# tick-sized tables are rebalanced (AQE splits skew); facts (a market-day per
# row or coarser) get one task per date
LARGE = {"price_changes"}

RULES = {
    "price_changes": Q.ticks_rules,
    "market_history": Q.history_rules,
    "category_activity": Q.activity_rules,
    "spread_over_time": Q.over_time_rules,
    "spread_distribution": Q.distribution_rules,
    "expiry_buckets": Q.expiry_rules,
    "category_concentration": Q.concentration_rules,
}


@dataclass
class RunResult:
    paths: dict
    emptied: dict = field(default_factory=dict)
    failures: list = field(default_factory=list)
    report: list = field(default_factory=list)


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_window(spark: SparkSession, path: str, start, end, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).where(in_window("date", start, end))


def run_window(spark: SparkSession, raw: DataFrame, dim: DataFrame, out_root: str, start, end,
               strict: bool = False, gate: bool = True, catalog: str | None = None) -> RunResult:
    """Build every table for ``[start, end)`` under ``out_root``.

    ``raw`` is the order book (e.g. ``sources.raw.scan_raw``), ``dim`` the
    stored market dimension. ``catalog`` is the prefix of the tables' names in
    the session's catalog (``"liquidity."``); without it they are folders.
    Returns the paths, the window dates left empty per table, and the quality
    report rows.
    """
    paths = {name: _path(out_root, name) for name in TABLES}
    result = RunResult(paths)
    schemas, checks = {}, []

    def write(name: str, df: DataFrame, given: dict | None = None) -> None:
        keys, tie = CLUSTER[name]
        observed, finish = Q.observe_rules(df, RULES[name](), table=name, given=given)
        fresh = observed.drop("_share_sum")
        schemas[name] = fresh.schema
        if catalog is None:
            result.emptied[name] = SK.write_window(fresh, paths[name], start, end, cluster_by=keys,
                                                   tie_breaker=tie, large=name in LARGE)
        else:
            C.ensure_catalog_table(spark, catalog + name, fresh.schema, paths[name])
            result.emptied[name] = C.replace_partitions(fresh, catalog + name, start, end, cluster_by=keys,
                                                        tie_breaker=tie, large=name in LARGE)
        checks.extend(finish())

    def read(name: str) -> DataFrame:
        if catalog is not None:
            return C.read_partitions(spark, catalog + name, start, end)
        return read_window(spark, paths[name], start, end, schemas[name])

    # 1. ticks: the only step that parses JSON; the update type and the window
    #    reach the scan, and the ticks are checked as they are written
    write("price_changes", K.price_changes(raw, start, end, strict=strict))
    ticks = read("price_changes")

    # 2. market-day aggregate, shared by history and activity
    markets = M.markets_view(dim)
    stats_path = scratch_path(spark, "market_day_stats")
    try:
        stats = materialize(R.market_day_stats(ticks, start, end), path=stats_path)
        write("market_history", R.market_history(None, markets, stats=stats))
        write("category_activity", R.category_activity(None, markets, stats=stats))
    finally:
        SK.remove_dir(spark, stats_path)

    # 3. hourly and tier facts straight from the ticks table
    write("spread_over_time", R.spread_over_time(ticks, start, end))
    write("spread_distribution", R.spread_distribution(ticks, start, end))

    # 4. facts of facts; a category-day's share sum comes with its rows
    history = read("market_history")
    activity = read("category_activity")
    write("expiry_buckets", R.expiry_buckets(history, start, end))
    once = F.col("market_rank_in_category") == 1
    write("category_concentration", R.category_concentration(history, activity, start, end, with_share_sum=True),
          {Q.SHARE_SUM_CHECK: (F.col("_share_sum"), once)})

    # 5. the raw rows of the window
    report = Q.quality_report(K.window_rows(raw, start, end), Q.orderbook_rules(), table="orderbook")
    result.report = [r.asDict() for r in report.collect()] + checks
    if gate:
        result.failures = Q.gate(result.report)
    return result


def dimension_report(dim: DataFrame) -> list[dict]:
    """Rules of a dimension and of the view on it, one row per rule."""
    report = Q.quality_report(dim, Q.dim_rules(), table="dim_markets").unionByName(
        Q.quality_report(M.markets_view(dim), Q.view_rules(), table="markets_view"))
    return [r.asDict() for r in report.collect()]


def update_dimension(spark: SparkSession, raw: DataFrame, dim_path: str, payload: DataFrame,
                     event_tags: DataFrame, start, end, ids: DataFrame | None = None,
                     retry_ghosts: bool = False) -> tuple[DataFrame, list[dict]]:
    """Discovery, enrichment, check and merge: ids of the window's raw rows
    that the stored dimension lacks are looked up in the landed metadata (ghost
    rows where there is none) and appended, one row per id. What the dimension
    would be is checked first: on a blocking failure nothing is appended.

    ``ids`` are the market ids of the window where the ingest keeps them
    (``ingest.market_ids``); without it they are read from ``raw``.
    ``retry_ghosts`` looks ghosts up again; the row of one that is found is
    added, its ghost row stays (the dimension is insert-only, and the view
    shows no ghosts). Malformed payload (``payload.split_payload``) is counted
    in the report. Returns the dimension and the report."""
    SK.ensure_table(spark, dim_path, S.DIM_MARKETS, partition_col=None)
    with SK.writer_lock(spark, dim_path):
        dim = spark.read.schema(S.DIM_MARKETS).parquet(dim_path)
        checks = []
        if CORRUPT in payload.columns:
            checks = [r.asDict() for r in Q.quality_report(payload, Q.payload_rules(), table="market_payload").collect()]
            payload, _ = split_payload(payload)
        wanted = (M.new_market_ids(raw, dim, start, end, retry_ghosts) if ids is None
                  else M.new_market_ids(ids, dim, retry_ghosts=retry_ghosts))
        found = M.enrich_markets(wanted, payload, event_tags)
        held = dim.select("market_id", "is_ghost")
        known = held.where(F.col("is_ghost") == F.lit(False)) if retry_ghosts else held
        path = scratch_path(spark, "dimension_inserts")
        try:
            new = SK.merge_inserts(known, found, dedup=True)
            if retry_ghosts:                                    # still a ghost: its row is there
                new = SK.merge_inserts(held, new.where("is_ghost")).unionByName(new.where("NOT is_ghost"))
            new = materialize(new, path=path)
            checks += dimension_report(dim.unionByName(new))
            Q.gate(checks)
            new.write.format("parquet").mode("append").save(dim_path)
        finally:
            SK.remove_dir(spark, path)
        return spark.read.schema(S.DIM_MARKETS).parquet(dim_path), checks


def run_daily(spark: SparkSession, raw: DataFrame, dim_path: str, payload: DataFrame,
              event_tags: DataFrame, out_root: str, start, end, ids: DataFrame | None = None,
              retry_ghosts: bool = False, **kw) -> RunResult:
    """The whole chain for ``[start, end)``: the dimension is checked and
    brought up to date, then every table is built with it."""
    dim, checks = update_dimension(spark, raw, dim_path, payload, event_tags, start, end, ids, retry_ghosts)
    result = run_window(spark, raw, dim, out_root, start, end, **kw)
    result.report = checks + result.report
    return result


class BackfillFailures(RuntimeError):
    """Some windows of a backfill failed; ``failed`` lists them, ``results``
    has the results of the others."""

    def __init__(self, failed: list[tuple], results: list[RunResult]):
        self.failed, self.results = failed, results
        super().__init__("failed windows: " + "; ".join(f"[{a}, {b}): {why}" for a, b, why in failed))


def run_backfill(spark: SparkSession, raw_root: str, dim: DataFrame, out_root: str, start, end,
                 days_per_run: int = 7, **kw) -> list[RunResult]:
    """Backfill ``[start, end)`` in consecutive windows of ``days_per_run``.

    Each window is an independent, idempotent ``run_window`` over
    ``sources.raw.scan_raw`` (pruned to its dates), so every job's input is
    bounded and a failure costs only its window: the others are run, and the
    failed ones are reported at the end by ``BackfillFailures``. Re-running the
    backfill replaces windows, never duplicates them. The loop is over date
    windows (metadata), not rows."""
    days = SK.date_range(start, end)
    results, failed = [], []
    for i in range(0, len(days), days_per_run):
        w_start = days[i]
        w_end = days[min(i + days_per_run, len(days)) - 1] + timedelta(days=1)
        try:
            raw = scan_raw(spark, raw_root, w_start, w_end)
            results.append(run_window(spark, raw, dim, out_root, w_start, w_end, **kw))
        except Exception as exc:   # noqa: BLE001 - collected per window, reported below
            failed.append((w_start, w_end, f"{type(exc).__name__}: {str(exc)[:200]}"))
    if failed:
        raise BackfillFailures(failed, results)
    return results
