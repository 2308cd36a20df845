"""Deterministic projections of the driver's tables into the library's inputs.

The test tables are TPC-H-like plus an ``events`` stream; these functions map
them onto the order-book and market-metadata shapes with integer arithmetic and
string building only, so an independent SQL engine can rebuild exactly the same
text. They are ordinary distributed DataFrame transforms: their cost grows with
the input tables and nothing is collected.

Rules (fixed values, see FIXTURES.md):

order book from ``events``
  timestamp_received   ts (as an instant, UTC)
  timestamp_created_at ts minus 23 ms
  market_id            'm' || user_id
  update_type          book_snapshot when event_type = 'error', else price_change
  b (mills)            500 when user_id % 29 = 0, else (event_id*37 + user_id*13) % 1030
  s (mills)            (event_id*7 + user_id*3) % 80 - 4
  side                 MAYBE when event_id % 97 = 0, YES when event_id even, else NO
  best_bid             decimal text of b; key omitted when event_id % 101 = 0
  best_ask             decimal text of b + s, with a 'd' behind it (which is no
                       price) when event_id % 103 = 0
  token_id             event_id;  change_size  event_id % 50;  change_side  BUY
  data                 JSON object; for book_snapshot [{"price":"0.5","size":"10"}]

dimension from ``customer``
  market_id            'x' || c_custkey when c_custkey % 19 = 0 (ids no tick
                       has, so those markets' ticks find no row), else
                       'm' || c_custkey
  question             c_name
  event_title          'ev' || (c_custkey % 10)
  category             NULL when c_custkey % 13 = 0, else c_mktsegment
  category_slug        NULL when c_custkey % 13 = 0, else lower(c_mktsegment)
  end_date             NULL when c_custkey % 7 = 0; 'junk' when % 17 = 0;
                       '12:30' (no date) when % 23 = 0;
                       else 2024-01-01 + (c_custkey % 60) days as YYYY-MM-DD
  closed               c_acctbal < 0
  resolution_status    NULL
  is_ghost             c_custkey % 11 = 0
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

SNAPSHOT_PAYLOAD = '[{"price":"0.5","size":"10"}]'


def _mills_sql(n: str) -> str:
    """SQL text: decimal text of an integer number of thousandths
    (1029 -> '1.029', -4 -> '-0.004')."""
    return (f"concat(CASE WHEN ({n}) < 0 THEN '-' ELSE '' END, "
            f"CAST(div(abs({n}), 1000) AS STRING), '.', "
            f"lpad(CAST(abs({n}) % 1000 AS STRING), 3, '0'))")


_BID = "CASE WHEN user_id % 29 = 0 THEN 500 ELSE (event_id * 37 + user_id * 13) % 1030 END"
_ASK = f"({_BID}) + ((event_id * 7 + user_id * 3) % 80 - 4)"
_SIDE = "CASE WHEN event_id % 97 = 0 THEN 'MAYBE' WHEN event_id % 2 = 0 THEN 'YES' ELSE 'NO' END"

# One projection (a single expression tree per column) keeps plan building
# cheap; to_json drops NULL fields, which is how the bid key goes missing.
_ORDERBOOK_SQL = [
    "CAST(ts AS TIMESTAMP) AS timestamp_received",
    "CAST(ts AS TIMESTAMP) - INTERVAL 23 MILLISECONDS AS timestamp_created_at",
    "concat('m', CAST(user_id AS STRING)) AS market_id",
    f"CASE WHEN event_type = 'error' THEN '{S.UPDATE_BOOK_SNAPSHOT}' "
    f"ELSE '{S.UPDATE_PRICE_CHANGE}' END AS update_type",
    f"""CASE WHEN event_type = 'error' THEN '{SNAPSHOT_PAYLOAD}' ELSE to_json(named_struct(
        'update_type', '{S.UPDATE_PRICE_CHANGE}',
        'market_id', concat('m', CAST(user_id AS STRING)),
        'token_id', CAST(event_id AS STRING),
        'side', {_SIDE},
        'best_bid', CASE WHEN event_id % 101 <> 0 THEN {_mills_sql(_BID)} END,
        'best_ask', concat({_mills_sql(_ASK)}, CASE WHEN event_id % 103 = 0 THEN 'd' ELSE '' END),
        'change_size', CAST(event_id % 50 AS STRING),
        'change_side', 'BUY')) END AS data""",
]

_DIM_SQL = [
    "concat(CASE WHEN c_custkey % 19 = 0 THEN 'x' ELSE 'm' END, CAST(c_custkey AS STRING)) "
    "AS market_id",
    "c_name AS question",
    "concat('ev', CAST(c_custkey % 10 AS STRING)) AS event_title",
    "CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS category",
    "CASE WHEN c_custkey % 13 <> 0 THEN lower(c_mktsegment) END AS category_slug",
    "CASE WHEN c_custkey % 7 = 0 THEN CAST(NULL AS STRING) WHEN c_custkey % 17 = 0 THEN 'junk' "
    "WHEN c_custkey % 23 = 0 THEN '12:30' "
    "ELSE date_format(date_add(DATE'2024-01-01', CAST(c_custkey % 60 AS INT)), 'yyyy-MM-dd') END "
    "AS end_date",
    "c_acctbal < 0 AS closed",
    "CAST(NULL AS STRING) AS resolution_status",
    "c_custkey % 11 = 0 AS is_ghost",
]


def orderbook_from_events(events: DataFrame) -> DataFrame:
    """Raw order-book rows (``schemas.RAW_ORDERBOOK``) from ``events``."""
    return events.selectExpr(*_ORDERBOOK_SQL)


def dim_from_customer(customer: DataFrame) -> DataFrame:
    """Market dimension rows (``schemas.DIM_MARKETS``) from ``customer``."""
    return customer.selectExpr(*_DIM_SQL)


# --------------------------------------------------------------------------
# Market metadata from ``customer`` (for discovery, enrichment and merges).
#
# Tag list: bit i of the key's tag number selects tag i of TAG_POOL (in this
# order). The pool puts a rewards label, an empty label and a free label ahead
# of the eight canonical tags, so every branch of the category choice occurs.
# --------------------------------------------------------------------------
TAG_POOL = (
    ("9001", "Weekly Rewards"),
    ("9002", ""),
    ("9003", "Hot Topics"),
    ("596", "Culture"),
    ("120", "Finance"),
    ("2", "Politics"),
    ("100265", "Geopolitics"),
    ("21", "Crypto"),
    ("100639", "Games"),
    ("1", "Sports"),
    ("1401", "Tech"),
)


def tags_for(n: Column) -> Column:
    """array<struct<id, label>>: TAG_POOL entries whose bit is set in n."""
    picked = [F.when(F.shiftright(n, i).bitwiseAND(1) == 1,
                     F.struct(F.lit(tid).alias("id"), F.lit(label).alias("label")))
              for i, (tid, label) in enumerate(TAG_POOL)]
    return F.filter(F.array(*picked), lambda t: t.isNotNull())


def market_key(market_id: str | Column = "market_id") -> Column:
    c = F.col(market_id) if isinstance(market_id, str) else market_id
    return F.substring(c, 2, 64).cast("long")


def market_tags_from_customer(customer: DataFrame) -> DataFrame:
    """(market_id, tags) with tags chosen by the bits of c_custkey."""
    k = F.col("c_custkey")
    return customer.select(F.concat(F.lit("m"), k.cast("string")).alias("market_id"),
                           tags_for(k).alias("tags"))


def market_payload_from_customer(customer: DataFrame) -> DataFrame:
    """Landed market metadata (``schemas.MARKET_PAYLOAD``); rows with
    c_custkey % 5 = 0 have an id that nobody asks for ('x' || key), so their
    markets get no answer.

    events: none when k % 6 = 0; else one event, id NULL when k % 4 = 0 (its
    own tags are then used) else 'e' || (k % 10), title 'Évent <k % 10>\\n'.
    endDateIso: NULL when k % 7 = 0, '' when k % 5 = 1, else 2024-01-01 +
    (k % 60) days; endDate: NULL when k % 7 = 0, else 2024-01-01 + (k % 45)
    days at 12:00Z. closed: NULL when k % 8 = 0, else c_acctbal < 0.
    umaResolutionStatus: 'resolved' (k % 3 = 0), '' (k % 3 = 1), else NULL;
    umaResolutionStatuses: by k % 8 a list of two (0), an empty list (1), text
    that looks like that list (4) or like the empty one (5), else NULL.
    """
    k = F.col("c_custkey")
    base = F.lit("2024-01-01").cast("date")
    event = F.struct(
        F.when(k % 4 != 0, F.concat(F.lit("e"), (k % 10).cast("string"))).alias("id"),
        F.concat(F.lit("Évent "), (k % 10).cast("string"), F.lit("\n")).alias("title"),
        tags_for(k).alias("tags"),
    )
    statuses = F.when(k % 8 == 0, F.lit('["disputed","resolved"]')).when(k % 8 == 1, F.lit("[]")) \
        .when(k % 8 == 4, F.lit('"[\\"disputed\\",\\"resolved\\"]"')).when(k % 8 == 5, F.lit('"[]"'))
    return customer.select(
        F.concat(F.when(k % 5 == 0, F.lit("x")).otherwise(F.lit("m")), k.cast("string")).alias("conditionId"),
        F.col("c_name").alias("question"),
        F.when(k % 6 == 0, F.array().cast("array<struct<id:string,title:string,"
                                          "tags:array<struct<id:string,label:string>>>>"))
         .otherwise(F.array(event)).alias("events"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .when(k % 5 == 1, F.lit(""))
         .otherwise(F.date_format(F.date_add(base, (k % 60).cast("int")), "yyyy-MM-dd"))
         .alias("endDateIso"),
        F.when(k % 7 != 0, F.concat(F.date_format(F.date_add(base, (k % 45).cast("int")),
                                                  "yyyy-MM-dd"), F.lit("T12:00:00Z")))
         .alias("endDate"),
        F.when(k % 8 != 0, F.col("c_acctbal") < 0).alias("closed"),
        F.when(k % 3 == 0, F.lit("resolved")).when(k % 3 == 1, F.lit("")).alias(
            "umaResolutionStatus"),
        F.parse_json(statuses).alias("umaResolutionStatuses"),
    )


def landed_lines_from_customer(customer: DataFrame) -> DataFrame:
    """Landed metadata as lines of JSON text (``value``): a line is cut after
    40 characters when c_custkey % 9 = 0, and no object (the list ["x"]) when
    c_custkey % 31 = 0."""
    payload = market_payload_from_customer(customer)
    key = F.substring("conditionId", 2, 64).cast("long")
    line = F.to_json(F.struct(*payload.columns))
    return payload.select(F.when(key % 9 == 0, F.substring(line, 1, 40)).when(key % 31 == 0, F.lit('["x"]'))
                          .otherwise(line).alias("value"))


# fixed values: the ways a date is written by c_custkey % 12; the last two are
# no dates
DATE_TEXTS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "MM/dd/yyyy", "MMMM d, yyyy", "d MMM yyyy",
              "yyyy-MM-dd'T'HH:mm:ss'Z'", "MM/dd/yyyy HH:mm", "EEE, dd MMM yyyy HH:mm:ss 'GMT'", "yyyy.MM.dd",
              "HH:mm", "'Q1 'yyyy")


def dated_texts_from_customer(customer: DataFrame) -> DataFrame:
    """(market_id, text): the date 2024-01-01 + (k % 366) days at 23:30, as
    ``DATE_TEXTS`` of k % 12."""
    k = F.col("c_custkey")
    at = F.date_add(F.lit("2024-01-01").cast("date"), (k % 366).cast("int")).cast("timestamp") + F.expr(
        "INTERVAL '23:30' HOUR TO MINUTE")
    texts = F.array(*[F.date_format(at, f) for f in DATE_TEXTS])
    return customer.select(F.concat(F.lit("m"), k.cast("string")).alias("market_id"),
                           F.get(texts, (k % 12).cast("int")).alias("text"))


def event_tags_from_customer(customer: DataFrame) -> DataFrame:
    """Tags per event id 'e0'..'e9' (the answers for 8 and 9 carry ids 'x8' and
    'x9', which stands for a failed lookup). Tag bits: j * 113."""
    j = F.col("c_custkey") % 10
    return customer.select(j.alias("j")).distinct().select(
        F.concat(F.when(F.col("j") < 8, F.lit("e")).otherwise(F.lit("x")), F.col("j").cast("string"))
         .alias("event_id"),
        tags_for(F.col("j") * 113).alias("tags"),
    )


# --------------------------------------------------------------------------
# Bad rows for the quality queries, and an hour that never landed: existing
# rows are changed, none is added or left out.
# --------------------------------------------------------------------------
def _changed(df: DataFrame, **columns) -> DataFrame:
    return df.withColumns({c: F.expr(e).cast(df.schema[c].dataType) for c, e in columns.items()})


def spoiled_orderbook(orderbook: DataFrame) -> DataFrame:
    """Markets with key % 23 = 0 have an unknown update type, those with
    key % 31 = 0 no payload."""
    key = "CAST(substr(market_id, 2) AS BIGINT)"
    return _changed(orderbook, update_type=f"CASE WHEN {key} % 23 = 0 THEN 'mystery' ELSE update_type END",
                    data=f"CASE WHEN {key} % 31 <> 0 THEN data END")


def spoiled_ticks(ticks: DataFrame) -> DataFrame:
    """Markets with key % 23 = 0 have bids of -0.5, those with key % 31 = 0 no side."""
    key = "CAST(substr(market_id, 2) AS BIGINT)"
    return _changed(ticks, best_bid=f"CASE WHEN {key} % 23 = 0 THEN -0.5D ELSE best_bid END",
                    side=f"CASE WHEN {key} % 31 <> 0 THEN side END")


def spoiled_dim(dim: DataFrame) -> DataFrame:
    """Keys % 37 = 0 have no id, keys % 41 = 0 a blank one."""
    key = "CAST(substr(market_id, 2) AS BIGINT)"
    return _changed(dim, market_id=f"CASE WHEN {key} % 37 = 0 THEN NULL WHEN {key} % 41 = 0 THEN '  ' "
                                   "ELSE market_id END")


# fixed values: what is wrong in each fact, as SQL that both engines read
SPOILED_FACTS = {
    "category_activity": {"avg_spread": "CASE WHEN category = 'BUILDING' THEN 1.5 ELSE avg_spread END",
                          "tick_count": "CASE WHEN category = 'MACHINERY' THEN 0 ELSE tick_count END"},
    "market_history": {"avg_spread": "CASE WHEN category = 'BUILDING' THEN -0.5 ELSE avg_spread END",
                       "tick_count": "CASE WHEN category = 'MACHINERY' THEN -1 ELSE tick_count END"},
    "spread_over_time": {"avg_spread": "CASE WHEN hour(hour) = 3 THEN NULL WHEN hour(hour) = 4 THEN 2 ELSE avg_spread END"},
    "spread_distribution": {"tick_count": "CASE WHEN spread_tier LIKE '3%' THEN 0 ELSE tick_count END"},
    "expiry_buckets": {"expiry_bucket_order": "CASE WHEN expiry_bucket = '0-1d' THEN 6 ELSE expiry_bucket_order END"},
    "category_concentration": {
        "market_tick_share": "CASE WHEN market_rank_in_category = 1 THEN 1.25 ELSE market_tick_share END",
        "hhi_concentration_index": "CASE WHEN category = 'BUILDING' THEN -0.25 ELSE hhi_concentration_index END"},
}


def spoiled_fact(df: DataFrame, name: str) -> DataFrame:
    return _changed(df, **SPOILED_FACTS[name])


def landed_late(orderbook: DataFrame) -> DataFrame:
    """The order book as its files landed, with the rows of 05h in the file of
    06h: that hour's slot is missing on every date."""
    late = F.hour("timestamp_received") == 5
    return orderbook.withColumn("timestamp_received", F.when(late, F.col("timestamp_received") + F.expr(
        "INTERVAL 1 HOUR")).otherwise(F.col("timestamp_received")))
