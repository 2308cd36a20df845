"""Table schemas and fixed label values.

Schemas are declared, never inferred: the raw payload is schema-on-read text,
everything after it is typed.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Raw order book: one row per token per order-book event, payload as JSON text.
# --------------------------------------------------------------------------
RAW_ORDERBOOK = T.StructType([
    T.StructField("timestamp_received", T.TimestampType()),
    T.StructField("timestamp_created_at", T.TimestampType()),
    T.StructField("market_id", T.StringType()),
    T.StructField("update_type", T.StringType()),
    T.StructField("data", T.StringType()),
])

PRICE_CHANGES = T.StructType([
    T.StructField("timestamp_received", T.TimestampType()),
    T.StructField("market_id", T.StringType()),
    T.StructField("token_id", T.StringType()),
    T.StructField("side", T.StringType()),
    T.StructField("best_bid", T.DoubleType()),
    T.StructField("best_ask", T.DoubleType()),
    T.StructField("spread", T.DoubleType()),
    T.StructField("change_size", T.DoubleType()),
    T.StructField("change_side", T.StringType()),
    T.StructField("date", T.DateType()),
])

# Market dimension as stored (insert-only); end_date is YYYY-MM-DD text.
DIM_MARKETS = T.StructType([
    T.StructField("market_id", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("event_title", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("category_slug", T.StringType()),
    T.StructField("end_date", T.StringType()),
    T.StructField("closed", T.BooleanType()),
    T.StructField("resolution_status", T.StringType()),
    T.StructField("is_ghost", T.BooleanType()),
])

TAG = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("label", T.StringType()),
])

EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("tags", T.ArrayType(TAG)),
])

# Landed market metadata (one JSON object per market, API field names).
MARKET_PAYLOAD = T.StructType([
    T.StructField("conditionId", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("events", T.ArrayType(EVENT)),
    T.StructField("endDateIso", T.StringType()),
    T.StructField("endDate", T.StringType()),
    T.StructField("closed", T.BooleanType()),
    T.StructField("umaResolutionStatus", T.StringType()),
    # text or a list in the landed objects: kept with its type
    T.StructField("umaResolutionStatuses", T.VariantType()),
])

EVENT_TAGS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("tags", T.ArrayType(TAG)),
])

# --------------------------------------------------------------------------
# Fixed values that must equal the source system's for equal results.
# --------------------------------------------------------------------------
UPDATE_PRICE_CHANGE = "price_change"
UPDATE_BOOK_SNAPSHOT = "book_snapshot"
UPDATE_TYPES = (UPDATE_PRICE_CHANGE, UPDATE_BOOK_SNAPSHOT)
SIDES = ("YES", "NO")

# Defaults of the markets view.
VIEW_UNKNOWN_CATEGORY = "Unknown"
VIEW_UNKNOWN_SLUG = "unknown"

# Defaults for ticks whose market has no row in the view.
MISSING_QUESTION = "Market metadata unavailable"
MISSING_EVENT_TITLE = "Unknown Event"
MISSING_CATEGORY = "Unknown / Deleted"
MISSING_SLUG = "unknown-deleted"

# Spread tiers: (upper bound inclusive, label); the last tier has no bound.
TIER_TIGHT = "1. Tight (< $0.02)"
TIER_MEDIUM = "2. Medium ($0.02 - $0.05)"
TIER_WIDE = "3. Wide (> $0.05)"
TIER_BOUNDS = ((0.02, TIER_TIGHT), (0.05, TIER_MEDIUM))

# Expiry buckets: label, sort order, inclusive day range (None = open).
EXPIRY_BUCKETS = (
    ("expired", 5, None, -1),
    ("0-1d", 1, 0, 1),
    ("2-7d", 2, 2, 7),
    ("8-30d", 3, 8, 30),
    ("31d+", 4, 31, None),
)

# Ghost markets: ids the metadata source could not resolve.
GHOST_QUESTION = "Ghost Market - no API data"
ENRICH_UNKNOWN = "Unknown"
ENRICH_UNKNOWN_SLUG = "unknown"

# Canonical platform tags: id, label, slug. Listed in priority order; when a
# market carries several, the one listed LAST wins (the source loop has no
# break), which makes the effective order Tech > Sports > Games > Crypto >
# Geopolitics > Politics > Finance > Culture.
CANONICAL_TAGS = (
    ("596", "Culture", "pop-culture"),
    ("120", "Finance", "finance"),
    ("2", "Politics", "politics"),
    ("100265", "Geopolitics", "geopolitics"),
    ("21", "Crypto", "crypto"),
    ("100639", "Games", "games"),
    ("1", "Sports", "sports"),
    ("1401", "Tech", "tech"),
)
# Fallback skips tag labels containing this word (case-insensitive).
REWARDS_WORD = "rewards"

# Landed hourly files are named by this slot label.
HOUR_SLOT_FORMAT = "yyyy-MM-dd'T'HH"
PARQUET_MAGIC = b"PAR1"
