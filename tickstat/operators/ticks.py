"""Raw order book -> cleansed price-change ticks.

At the source's scale (~7.5e8 raw rows a day) the JSON payload is the dominant
CPU cost, so the transform is shaped around it:

1. ``update_type = 'price_change'`` and the date window are applied first:
   the equality and, on a date-partitioned raw table, the ``date`` predicate
   reach the Parquet scan (``PushedFilters`` / ``PartitionFilters``), and only
   the four used columns are read.
2. The payload is parsed **once** per row with ``json_tuple`` (one streaming
   parse returning every field as text). A generator is used on purpose: the
   guards that follow cannot be pushed below it, so the optimizer cannot
   re-inline one parse per referenced field the way it does for
   ``get_json_object`` / ``from_json`` columns. Fields are read scalar-only
   (an object or array value is NULL, see ``json_scalar``).
3. Text -> float64 with ``try_cast``: a malformed price rejects the row (and is
   counted by ``reject_report``) instead of failing a 750M-row job;
   ``strict=True`` restores the hard cast.

Everything is a narrow transformation: no shuffle, so it scales linearly with
executors and is skew-free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import in_window, json_scalar, to_double

_FIELDS = ("token_id", "side", "best_bid", "best_ask", "change_size", "change_side")


def window_rows(orderbook: DataFrame, start, end) -> DataFrame:
    """Window on DATE(timestamp_received); a raw table partitioned by ``date``
    (= DATE(timestamp_received), as ``sinks.overwrite_partition`` writes it)
    gets the same predicate on the partition column for pruning."""
    df = orderbook
    if start is None and end is None:
        return df
    if "date" in df.columns:
        df = df.where(in_window("date", start, end))
    return df.where(in_window(F.to_date("timestamp_received"), start, end))


def parsed_price_changes(orderbook: DataFrame, start=None, end=None) -> DataFrame:
    """price_change rows of the window with the payload fields as text
    (``*_text`` columns), before any guard. Shared by the tick transform and
    the reject report."""
    df = window_rows(orderbook.where(F.col("update_type") == S.UPDATE_PRICE_CHANGE),
                        start, end)
    parsed = df.select(
        "timestamp_received", "market_id", "data",
        F.json_tuple("data", *_FIELDS).alias(*[f"{f}_raw" for f in _FIELDS]),
    )
    return parsed.select(
        "timestamp_received", "market_id",
        *[json_scalar(f"{f}_raw", "data", f).alias(f"{f}_text") for f in _FIELDS])


def price_changes(orderbook: DataFrame, start=None, end=None, strict: bool = False) -> DataFrame:
    """Cleansed ticks (``schemas.PRICE_CHANGES``) of ``[start, end)``.

    Kept rows: price_change events whose bid and ask are present, whose side is
    YES or NO, whose prices lie in [0, 1] (NaN fails) and that are not inverted
    (ask >= bid). Rejected rows are dropped, as in the source.
    """
    p = parsed_price_changes(orderbook, start, end)
    bid = to_double("best_bid_text", strict)
    ask = to_double("best_ask_text", strict)
    typed = p.select(
        "timestamp_received",
        "market_id",
        F.col("token_id_text").alias("token_id"),
        F.col("side_text").alias("side"),
        bid.alias("best_bid"),
        ask.alias("best_ask"),
        to_double("change_size_text", strict).alias("change_size"),
        F.col("change_side_text").alias("change_side"),
    )
    kept = typed.where(
        F.col("best_bid").isNotNull() & F.col("best_ask").isNotNull()
        & F.col("side").isin(*S.SIDES)
        & F.col("best_bid").between(0.0, 1.0)
        & F.col("best_ask").between(0.0, 1.0)
        & (F.col("best_ask") >= F.col("best_bid"))
    )
    return kept.select(
        "timestamp_received", "market_id", "token_id", "side", "best_bid", "best_ask",
        (F.col("best_ask") - F.col("best_bid")).alias("spread"),
        "change_size", "change_side",
        F.to_date("timestamp_received").alias("date"),
    )


def reject_report(orderbook: DataFrame, start=None, end=None) -> DataFrame:
    """Per date: price_change rows and how many fail each guard.

    Guards are counted independently (a row can fail several); ``rejected`` and
    ``kept`` partition the rows. One pass, one tiny shuffle (partial
    aggregation leaves at most one row per date per task).
    """
    p = parsed_price_changes(orderbook, start, end)
    bid_t, ask_t, side = F.col("best_bid_text"), F.col("best_ask_text"), F.col("side_text")
    bid, ask = to_double(bid_t), to_double(ask_t)
    good_side = F.coalesce(side.isin(*S.SIDES), F.lit(False))
    bid_in = F.coalesce(bid.between(0.0, 1.0), F.lit(False))
    ask_in = F.coalesce(ask.between(0.0, 1.0), F.lit(False))
    not_inverted = F.coalesce(ask >= bid, F.lit(False))
    keep = bid_t.isNotNull() & ask_t.isNotNull() & good_side & bid_in & ask_in & not_inverted
    counts = {
        "missing_bid": bid_t.isNull(),
        "missing_ask": ask_t.isNull(),
        "bad_side": ~good_side,
        "unparsable_bid": bid_t.isNotNull() & bid.isNull(),
        "unparsable_ask": ask_t.isNotNull() & ask.isNull(),
        "bid_out_of_bounds": bid.isNotNull() & ~bid_in,
        "ask_out_of_bounds": ask.isNotNull() & ~ask_in,
        "inverted": bid.isNotNull() & ask.isNotNull() & ~not_inverted,
        "kept": keep,
    }
    agg = p.groupBy(F.to_date("timestamp_received").alias("date")).agg(
        F.count(F.lit(1)).alias("price_change_rows"),
        *[F.count_if(cond).alias(name) for name, cond in counts.items()],
    )
    return agg.withColumn("rejected", F.col("price_change_rows") - F.col("kept"))
