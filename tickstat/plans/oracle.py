"""Independent SQL (DuckDB dialect) for each registered query.

The fixture projection is rebuilt with string concatenation and the payload
read with ``json_extract_string``. Reports are worked out from their
definitions in another way than in Spark: every tick gets its market's label
first and is grouped by it, correlations come from moments, ranks from counting
the markets that are ahead, shares from grouped totals, expiry buckets from a
table of ranges. Doubles are rounded to 9 places like ``registry.present``;
HUGEINT sums are cast back to BIGINT. Fixed values are stated here again, not
taken from the package.
"""

from __future__ import annotations


def _mills(n: str) -> str:
    return (f"(CASE WHEN ({n}) < 0 THEN '-' ELSE '' END || CAST(abs({n}) // 1000 AS VARCHAR)"
            f" || '.' || lpad(CAST(abs({n}) % 1000 AS VARCHAR), 3, '0'))")


_BID = "(CASE WHEN user_id % 29 = 0 THEN 500 ELSE (event_id * 37 + user_id * 13) % 1030 END)"
_SPREAD = "((event_id * 7 + user_id * 3) % 80 - 4)"
_SIDE = ("(CASE WHEN event_id % 97 = 0 THEN 'MAYBE' WHEN event_id % 2 = 0 THEN 'YES' "
         "ELSE 'NO' END)")

ORDERBOOK = f"""
ob AS (
  SELECT
    CAST(ts AS TIMESTAMP) AS timestamp_received,
    CAST(ts AS TIMESTAMP) - INTERVAL 23 MILLISECOND AS timestamp_created_at,
    'm' || CAST(user_id AS VARCHAR) AS market_id,
    CASE WHEN event_type = 'error' THEN 'book_snapshot' ELSE 'price_change' END AS update_type,
    CASE WHEN event_type = 'error' THEN '[{{"price":"0.5","size":"10"}}]'
    ELSE '{{"update_type":"price_change","market_id":"m' || CAST(user_id AS VARCHAR)
      || '","token_id":"' || CAST(event_id AS VARCHAR)
      || '","side":"' || {_SIDE} || '"'
      || CASE WHEN event_id % 101 = 0 THEN '' ELSE ',"best_bid":"' || {_mills(_BID)} || '"' END
      || ',"best_ask":"' || {_mills(_BID + ' + ' + _SPREAD)}
      || CASE WHEN event_id % 103 = 0 THEN 'd"' ELSE '"' END
      || ',"change_size":"' || CAST(event_id % 50 AS VARCHAR) || '","change_side":"BUY"}}'
    END AS data
  FROM events
)"""

PARSED = """
pc AS (
  SELECT
    timestamp_received,
    market_id,
    json_extract_string(data, '$.token_id') AS token_id,
    json_extract_string(data, '$.side') AS side,
    json_extract_string(data, '$.best_bid') AS bid_t,
    json_extract_string(data, '$.best_ask') AS ask_t,
    json_extract_string(data, '$.change_size') AS size_t,
    json_extract_string(data, '$.change_side') AS change_side
  FROM ob
  WHERE update_type = 'price_change'
)"""

TICKS = """
ticks AS (
  SELECT
    timestamp_received,
    market_id,
    token_id,
    side,
    TRY_CAST(bid_t AS DOUBLE) AS best_bid,
    TRY_CAST(ask_t AS DOUBLE) AS best_ask,
    TRY_CAST(ask_t AS DOUBLE) - TRY_CAST(bid_t AS DOUBLE) AS spread,
    TRY_CAST(size_t AS DOUBLE) AS change_size,
    change_side,
    CAST(timestamp_received AS DATE) AS date
  FROM pc
  WHERE bid_t IS NOT NULL
    AND ask_t IS NOT NULL
    AND side IN ('YES', 'NO')
    AND TRY_CAST(bid_t AS DOUBLE) BETWEEN 0.0 AND 1.0
    AND TRY_CAST(ask_t AS DOUBLE) BETWEEN 0.0 AND 1.0
    AND TRY_CAST(ask_t AS DOUBLE) >= TRY_CAST(bid_t AS DOUBLE)
)"""

DIM = """
dim AS (
  SELECT
    CASE WHEN c_custkey % 19 = 0 THEN 'x' ELSE 'm' END || CAST(c_custkey AS VARCHAR) AS market_id,
    c_name AS question,
    'ev' || CAST(c_custkey % 10 AS VARCHAR) AS event_title,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS category,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE lower(c_mktsegment) END AS category_slug,
    CASE WHEN c_custkey % 7 = 0 THEN NULL
         WHEN c_custkey % 17 = 0 THEN 'junk'
         WHEN c_custkey % 23 = 0 THEN '12:30'
         ELSE strftime(DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER), '%Y-%m-%d') END
      AS end_date,
    c_acctbal < 0 AS closed,
    CAST(NULL AS VARCHAR) AS resolution_status,
    c_custkey % 11 = 0 AS is_ghost
  FROM customer
)"""


def _view(name: str, source: str) -> str:
    return f"""
{name} AS (
  FROM {source} AS d
  SELECT d.market_id, d.question, d.event_title,
    ifnull(d.category, 'Unknown') AS category, ifnull(d.category_slug, 'unknown') AS category_slug,
    TRY_CAST(CASE WHEN d.end_date LIKE '____-__-__%' THEN d.end_date END AS TIMESTAMP) AS end_date,
    d.closed, d.resolution_status
  WHERE NOT d.is_ghost
)"""


def _labelled(name: str, ticks: str, view: str) -> str:
    """Every tick with the row(s) of its market in the view, or a NULL label."""
    return f"""
{name} AS (
  FROM {ticks} AS t LEFT JOIN {view} AS d ON d.market_id = t.market_id
  SELECT t.date, t.market_id, t.side = 'YES' AS is_yes, t.best_bid AS bid, t.best_ask AS ask, t.spread,
    epoch_ms(t.timestamp_received) // 1000 AS sec,
    CASE WHEN d.market_id IS NOT NULL THEN {{'q': d.question, 't': d.event_title, 'c': d.category,
      's': d.category_slug, 'e': d.end_date, 'x': d.closed, 'r': d.resolution_status}} END AS label
  WHERE t.spread >= 0
)"""


def _history(name: str, labelled: str) -> str:
    return f"""
{name} AS (
  FROM (
    FROM {labelled}
    SELECT date, market_id, label, count(*) AS tick_count,
      avg(bid) FILTER (is_yes) AS yes_avg_bid, avg(ask) FILTER (is_yes) AS yes_avg_ask,
      min(bid) FILTER (is_yes) AS yes_min_bid, max(ask) FILTER (is_yes) AS yes_max_ask,
      avg(spread) AS avg_spread, sqrt(var_samp(spread)) AS spread_volatility,
      min(spread) AS min_spread, max(spread) AS max_spread,
      covar_pop(sec, bid) FILTER (is_yes)
        / nullif(stddev_pop(sec) FILTER (is_yes) * stddev_pop(bid) FILTER (is_yes), 0) AS price_trend_corr
    GROUP BY ALL
  ) AS g
  SELECT date, market_id, ifnull(label.q, 'Market metadata unavailable') AS question,
    ifnull(label.t, 'Unknown Event') AS event_title, ifnull(label.c, 'Unknown / Deleted') AS category,
    ifnull(label.s, 'unknown-deleted') AS category_slug, label.e AS end_date, label.x AS closed,
    label.r AS resolution_status, * EXCLUDE (date, market_id, label)
)"""


def _activity(name: str, labelled: str) -> str:
    return f"""
{name} AS (
  FROM {labelled}
  SELECT date, ifnull(label.c, 'Unknown / Deleted') AS category,
    len(list_distinct(list(market_id))) AS market_count, count(*) AS tick_count,
    sum(spread) / count(*) AS avg_spread
  GROUP BY ALL
)"""


OVER_TIME = """
over_time AS (
  FROM ticks
  SELECT date, time_bucket(INTERVAL 1 HOUR, timestamp_received) AS "hour",
    avg(best_bid) FILTER (side = 'YES') AS yes_avg_bid, avg(best_ask) FILTER (side = 'YES') AS yes_avg_ask,
    avg(spread) AS avg_spread, sqrt(var_samp(spread)) AS stddev_spread, count(*) AS tick_count
  WHERE spread >= 0
  GROUP BY ALL
)"""

# fixed values: tiers by inclusive upper bound, buckets by range of days
DISTRIBUTION = """
tiers(spread_tier, above, upto) AS (VALUES
  ('1. Tight (< $0.02)', -1.0::DOUBLE, 0.02::DOUBLE), ('2. Medium ($0.02 - $0.05)', 0.02::DOUBLE, 0.05::DOUBLE),
  ('3. Wide (> $0.05)', 0.05::DOUBLE, 1.0::DOUBLE)),
distribution AS (
  FROM ticks JOIN tiers ON spread > above AND spread <= upto
  SELECT date, spread_tier, count(*) AS tick_count
  WHERE spread >= 0
  GROUP BY ALL
)"""

EXPIRY = """
ranges(expiry_bucket, expiry_bucket_order, lo, hi) AS (VALUES
  ('0-1d', 1, 0, 1), ('2-7d', 2, 2, 7), ('8-30d', 3, 8, 30), ('31d+', 4, 31, 9999999),
  ('expired', 5, -9999999, -1)),
expiry AS (
  FROM (FROM history SELECT *, CAST(end_date AS DATE) - date AS days) AS h JOIN ranges ON days BETWEEN lo AND hi
  SELECT date, expiry_bucket, expiry_bucket_order, count(*) AS market_count,
    CAST(sum(tick_count) AS BIGINT) AS total_tick_count,
    sum(tick_count) / count(*) AS avg_market_tick_count, avg(avg_spread) AS avg_spread,
    avg(spread_volatility) AS avg_spread_volatility, sum(days) / count(*) AS avg_days_to_expiry
  GROUP BY ALL
)"""

CONC = """
totals AS (
  FROM history SELECT date, category, CAST(sum(tick_count) AS BIGINT) AS category_tick_count,
    count(*) AS active_markets
  GROUP BY ALL
),
placed AS (
  FROM history AS a JOIN history AS b ON a.date = b.date AND a.category = b.category
  SELECT a.date, a.market_id, 1 + count_if(b.tick_count > a.tick_count
    OR (b.tick_count = a.tick_count AND b.market_id < a.market_id)) AS market_rank_in_category
  GROUP BY ALL
),
shared AS (
  FROM history JOIN totals USING (date, category) JOIN placed USING (date, market_id)
  SELECT date, category, market_id, question, tick_count AS market_tick_count, category_tick_count,
    active_markets, tick_count / category_tick_count AS market_tick_share,
    market_rank_in_category, avg_spread, spread_volatility
),
heads AS (
  FROM shared SELECT date, category, max(market_tick_share) AS top_market_share,
    sum(market_tick_share) FILTER (market_rank_in_category < 4) AS top_3_market_share,
    sum(market_tick_share * market_tick_share) AS hhi_concentration_index
  GROUP BY ALL
),
conc AS (FROM shared JOIN heads USING (date, category))"""

CTES = {
    "ob": ORDERBOOK, "pc": PARSED, "ticks": TICKS, "dim": DIM, "mk": _view("mk", "dim"),
    "labelled": _labelled("labelled", "ticks", "mk"), "history": _history("history", "labelled"),
    "activity": _activity("activity", "labelled"), "over_time": OVER_TIME, "distribution": DISTRIBUTION,
    "expiry": EXPIRY, "conc": CONC,
}
# dependencies, in definition order
_NEEDS = {
    "ob": [], "pc": ["ob"], "ticks": ["pc"], "dim": [], "mk": ["dim"], "labelled": ["ticks", "mk"],
    "history": ["labelled"], "activity": ["labelled"], "over_time": ["ticks"], "distribution": ["ticks"],
    "expiry": ["history"], "conc": ["history"],
}


def _closure(names):
    out = []

    def visit(n):
        for d in _NEEDS[n]:
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_ctes(needs, body: str, round_cols=(), bigint_cols=(), extra: str = "") -> str:
    """``WITH`` the needed fixture CTEs (plus ``extra`` ones), then ``body``;
    rounds and casts the listed output columns."""
    ctes = ",".join([CTES[n] for n in _closure(needs)] + ([extra] if extra else []))
    repl = [f"round({c}, 9) + 0.0 AS {c}" for c in round_cols]
    repl += [f"CAST({c} AS BIGINT) AS {c}" for c in bigint_cols]
    if repl:
        body = f"SELECT * REPLACE ({', '.join(repl)}) FROM ({body}) AS q"
    return f"WITH {ctes}\n{body}"


SQL: dict[str, str] = {}

_TICK_COLUMNS = ("timestamp_received, market_id, token_id, side, best_bid, best_ask, spread, change_size, "
                 "change_side, date")
_TICK_DOUBLES = ["best_bid", "best_ask", "spread", "change_size"]
_HIST_DOUBLES = ["yes_avg_bid", "yes_avg_ask", "yes_min_bid", "yes_max_ask", "avg_spread",
                 "spread_volatility", "min_spread", "max_spread", "price_trend_corr"]
_CONC_DOUBLES = ["market_tick_share", "avg_spread", "spread_volatility", "top_market_share",
                 "top_3_market_share", "hhi_concentration_index"]
_OVER_DOUBLES = ["yes_avg_bid", "yes_avg_ask", "avg_spread", "stddev_spread"]
_EXPIRY_DOUBLES = ["avg_market_tick_count", "avg_spread", "avg_spread_volatility", "avg_days_to_expiry"]
_WINDOW = "date >= DATE '2024-01-08' AND date < DATE '2024-01-15'"

SQL["reject_report"] = with_ctes(["pc"], """
SELECT
  date,
  COUNT(*) AS price_change_rows,
  count_if(bid_t IS NULL) AS missing_bid,
  count_if(ask_t IS NULL) AS missing_ask,
  count_if(side IS NULL OR side NOT IN ('YES', 'NO')) AS bad_side,
  count_if(bid_t IS NOT NULL AND bid IS NULL) AS unparsable_bid,
  count_if(ask_t IS NOT NULL AND ask IS NULL) AS unparsable_ask,
  count_if(bid IS NOT NULL AND NOT (bid BETWEEN 0.0 AND 1.0)) AS bid_out_of_bounds,
  count_if(ask IS NOT NULL AND NOT (ask BETWEEN 0.0 AND 1.0)) AS ask_out_of_bounds,
  count_if(bid IS NOT NULL AND ask IS NOT NULL AND NOT (ask >= bid)) AS inverted,
  count_if(bid_t IS NOT NULL AND ask_t IS NOT NULL AND side IN ('YES', 'NO')
           AND bid BETWEEN 0.0 AND 1.0 AND ask BETWEEN 0.0 AND 1.0 AND ask >= bid) AS kept,
  COUNT(*) - count_if(bid_t IS NOT NULL AND ask_t IS NOT NULL AND side IN ('YES', 'NO')
           AND bid BETWEEN 0.0 AND 1.0 AND ask BETWEEN 0.0 AND 1.0 AND ask >= bid) AS rejected
FROM (SELECT *, CAST(timestamp_received AS DATE) AS date,
             TRY_CAST(bid_t AS DOUBLE) AS bid, TRY_CAST(ask_t AS DOUBLE) AS ask FROM pc) AS p
GROUP BY date""", bigint_cols=["price_change_rows", "missing_bid", "missing_ask", "bad_side",
                                "unparsable_bid", "unparsable_ask", "bid_out_of_bounds",
                                "ask_out_of_bounds", "inverted", "kept", "rejected"])

SQL["markets_view"] = with_ctes(["mk"], "SELECT * FROM mk")

# whole range, and the report's own window: a day's rows depend on that day only
for _name, _cte, _columns, _doubles, _longs in (
        ("price_changes", "ticks", _TICK_COLUMNS, _TICK_DOUBLES, []),
        ("category_activity", "activity", "*", ["avg_spread"], ["market_count"]),
        ("market_history", "history", "*", _HIST_DOUBLES, []),
        ("spread_over_time", "over_time", "*", _OVER_DOUBLES, []),
        ("spread_distribution", "distribution", "*", [], []),
        ("expiry_buckets", "expiry", "*", _EXPIRY_DOUBLES, []),
        ("category_concentration", "conc", "*", _CONC_DOUBLES, ["active_markets", "market_rank_in_category"])):
    SQL[_name] = with_ctes([_cte], f"SELECT {_columns} FROM {_cte}", _doubles, _longs)
    SQL[f"{_name}_window"] = with_ctes([_cte], f"SELECT {_columns} FROM {_cte} WHERE {_WINDOW}", _doubles, _longs)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# ------------------------------------------------------------ quality rules
def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _report(table: str, src: str, rows: dict, sets: dict | None = None, warn=()) -> str:
    """``rows``: check -> predicate of a bad row, counted in one pass; ``sets``:
    check -> SQL scalar with the violations of the table as a whole."""
    counted = ", ".join(f"{{'c': {_q(c)}, 'v': count_if(coalesce({bad}, FALSE))}}" for c, bad in rows.items())
    whole = ", ".join(f"{{'c': {_q(c)}, 'v': ({sql})}}" for c, sql in (sets or {}).items())
    parts = ([f"SELECT unnest([{counted}]) AS x FROM {src}"] if counted else []) \
        + ([f"SELECT unnest([{whole}]) AS x"] if whole else [])
    warned = ", ".join(map(_q, ["", *warn]))
    return (f"SELECT {_q(table)} AS \"table\", x.c AS \"check\", CAST(x.v AS BIGINT) AS violations, "
            f"x.v = 0 AS passed, x.c NOT IN ({warned}) AS blocking FROM ({' UNION ALL '.join(parts)}) AS r_{table}")


def _empty(src: str) -> str:
    return f"SELECT CAST(NOT EXISTS (FROM {src}) AS INT)"


def _most_a_day(src: str, limit: int) -> str:
    return f"SELECT CAST(coalesce(max(n), {limit + 1}) > {limit} AS INT) FROM (SELECT count(*) AS n FROM {src} GROUP BY date)"


def _nulls(*columns):
    return {f"{c}: not_null": f'"{c}" IS NULL' for c in columns}


def _above_zero(*columns):
    return {f"{c}: positive": f"NOT ({c} > 0)" for c in columns}


def _from_zero(*columns):
    return {f"{c}: non_negative": f"NOT ({c} >= 0)" for c in columns}


def _upto(value, *columns):
    return {f"{c}: max {value}": f"NOT ({c} <= {value})" for c in columns}


def _complete(*columns) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


SQL["quality_orderbook"] = with_ctes(["ob"], _report(
    "orderbook", "bad", {
        "order book rows are complete and of a known type":
            f"NOT ({_complete('timestamp_received', 'market_id', 'update_type', 'data')} "
            "AND update_type IN ('book_snapshot', 'price_change'))"},
    {"order book has rows": _empty("bad"),
     "update_type: all of ['price_change', 'book_snapshot'] present":
         "SELECT 2 - count(DISTINCT update_type) FROM bad WHERE update_type IN ('book_snapshot', 'price_change')"},
    warn=["update_type: all of ['price_change', 'book_snapshot'] present"]), extra="""
bad AS (SELECT * REPLACE (
    CASE WHEN CAST(substr(market_id, 2) AS BIGINT) % 23 = 0 THEN 'mystery' ELSE update_type END AS update_type,
    CASE WHEN CAST(substr(market_id, 2) AS BIGINT) % 31 <> 0 THEN data END AS data) FROM ob)""")

SQL["quality_ticks"] = with_ctes(["ticks"], _report(
    "price_changes", "bad", {
        "ticks are complete, in bounds and not inverted":
            f"NOT coalesce({_complete('timestamp_received', 'market_id', 'spread')} AND side IN ('NO', 'YES') "
            "AND best_bid >= 0 AND best_ask <= 1 AND best_bid <= best_ask, FALSE)"},
    {"ticks have rows": _empty("bad")}), extra="""
bad AS (SELECT * REPLACE (
    CASE WHEN CAST(substr(market_id, 2) AS BIGINT) % 23 = 0 THEN -0.5 ELSE best_bid END AS best_bid,
    CASE WHEN CAST(substr(market_id, 2) AS BIGINT) % 31 <> 0 THEN side END AS side) FROM ticks)""")

SQL["quality_markets"] = with_ctes(["dim"], _report(
    "dim_markets", "bad", {"dimension rows have an id": "market_id IS NULL"},
    {"dimension has rows": _empty("bad"),
     "ghost share within its limit": "SELECT CAST(count_if(is_ghost) > 0.10 * count(*) AS INT) FROM bad"},
    warn=["ghost share within its limit"]) + "\nUNION ALL\n" + _report(
    "markets_view", "bad_view", {**_nulls("market_id"), "view ids are not blank": "length(trim(market_id)) = 0"},
    {"market_id: unique": "SELECT count(*) FROM (SELECT market_id FROM bad_view GROUP BY ALL HAVING count(*) > 1)"}),
    extra="""
bad AS (SELECT * REPLACE (
    CASE WHEN CAST(substr(market_id, 2) AS BIGINT) % 37 = 0 THEN NULL
         WHEN CAST(substr(market_id, 2) AS BIGINT) % 41 = 0 THEN '  ' ELSE market_id END AS market_id) FROM dim),"""
    + _view("bad_view", "bad"))

# fixed values: what the fixture spoils in each fact
_SPOILED = {
    "activity": "CASE WHEN category = 'BUILDING' THEN 1.5 ELSE avg_spread END AS avg_spread, "
                "CASE WHEN category = 'MACHINERY' THEN 0 ELSE tick_count END AS tick_count",
    "history": "CASE WHEN category = 'BUILDING' THEN -0.5 ELSE avg_spread END AS avg_spread, "
               "CASE WHEN category = 'MACHINERY' THEN -1 ELSE tick_count END AS tick_count",
    "over_time": "CASE WHEN hour(\"hour\") = 3 THEN NULL WHEN hour(\"hour\") = 4 THEN 2 ELSE avg_spread END AS avg_spread",
    "distribution": "CASE WHEN spread_tier LIKE '3%' THEN 0 ELSE tick_count END AS tick_count",
    "expiry": "CASE WHEN expiry_bucket = '0-1d' THEN 6 ELSE expiry_bucket_order END AS expiry_bucket_order",
    "conc": "CASE WHEN market_rank_in_category = 1 THEN 1.25 ELSE market_tick_share END AS market_tick_share, "
            "CASE WHEN category = 'BUILDING' THEN -0.25 ELSE hhi_concentration_index END AS hhi_concentration_index",
}
_SHARES = ("market_tick_share", "avg_spread", "top_market_share", "top_3_market_share", "hhi_concentration_index")
_HAS_ROWS = "fact has rows"

SQL["quality_facts"] = with_ctes(list(_SPOILED), "\nUNION ALL\n".join([
    _report("category_activity", "bad_activity", {
        **_nulls("date", "category"), **_above_zero("market_count", "tick_count"),
        **_from_zero("avg_spread"), **_upto(1.0, "avg_spread")}, {_HAS_ROWS: _empty("bad_activity")}),
    _report("market_history", "bad_history", {
        **_nulls("market_id"), **_above_zero("tick_count"), **_from_zero("avg_spread"),
        **_upto(1.0, "avg_spread")}, {_HAS_ROWS: _empty("bad_history")}),
    _report("spread_over_time", "bad_over_time", {
        **_nulls("date", "hour", "avg_spread", "tick_count"), **_above_zero("tick_count"),
        **_from_zero("avg_spread"), **_upto(1.0, "avg_spread")}, {_HAS_ROWS: _empty("bad_over_time")}),
    _report("spread_distribution", "bad_distribution", {
        **_nulls("date", "spread_tier"), **_above_zero("tick_count")},
        {_HAS_ROWS: _empty("bad_distribution"), "at most 3 tiers a day": _most_a_day("bad_distribution", 3)},
        warn=["at most 3 tiers a day"]),
    _report("expiry_buckets", "bad_expiry", {
        **_nulls("date", "expiry_bucket", "expiry_bucket_order"),
        **_above_zero("expiry_bucket_order", "market_count", "total_tick_count"), **_upto(5, "expiry_bucket_order"),
        **_from_zero("avg_market_tick_count", "avg_spread", "avg_spread_volatility"), **_upto(1, "avg_spread"),
        "bucket and order agree": "NOT EXISTS (FROM ranges r WHERE r.expiry_bucket = e.expiry_bucket "
                                  "AND r.expiry_bucket_order = e.expiry_bucket_order)"},
        {_HAS_ROWS: _empty("bad_expiry"), "at most 5 buckets a day": _most_a_day("bad_expiry", 5)},
        warn=["at most 5 buckets a day"]).replace("FROM bad_expiry UNION", "FROM bad_expiry e UNION"),
    _report("category_concentration", "bad_conc", {
        **_nulls("date", "category", "market_id"),
        **_above_zero("market_tick_count", "category_tick_count", "active_markets", "market_rank_in_category"),
        **_from_zero(*_SHARES, "spread_volatility"), **_upto(1.0, *_SHARES),
        "Herfindahl index within 0 and 1": "hhi_concentration_index NOT BETWEEN 0 AND 1.0001"},
        {_HAS_ROWS: _empty("bad_conc"),
         "shares of a category-day add up to 1":
             "SELECT count_if(abs(s - 1) > 0.0001) FROM (SELECT sum(market_tick_share) AS s FROM bad_conc GROUP BY date, category)"},
        warn=["Herfindahl index within 0 and 1"]),
]), extra=",".join(f"\nbad_{k} AS (SELECT * REPLACE ({v}) FROM {k})" for k, v in _SPOILED.items()))

SQL["ghost_ratio"] = with_ctes(["dim"], """
SELECT COUNT(*) AS markets, count_if(is_ghost) AS ghosts, avg(CAST(is_ghost AS INT)) AS ghost_ratio,
  avg(CAST(is_ghost AS INT)) > 0.10 AS above_limit
FROM dim""", round_cols=["ghost_ratio"], bigint_cols=["ghosts"])

SQL["share_sum_check"] = with_ctes(["conc"], """
SELECT date, category, ABS(SUM(market_tick_share) - 1.0) AS share_gap,
  ABS(SUM(market_tick_share) - 1.0) <= 0.0001 AS within_tolerance
FROM shared GROUP BY date, category""", round_cols=["share_gap"])


# ------------------------------------------------ slots, sinks, enrichment
_DAY_COUNTS = "SELECT CAST(timestamp_received AS DATE) AS date, COUNT(*) AS row_count FROM ob GROUP BY 1"
SQL["partition_row_counts"] = with_ctes(["ob"], _DAY_COUNTS)
SQL["partition_row_counts_window"] = with_ctes(["ob"], f"SELECT * FROM ({_DAY_COUNTS}) AS c WHERE {_WINDOW}")

SLOTS = """
bounds AS (
  SELECT min(CAST(timestamp_received AS DATE)) AS s, max(CAST(timestamp_received AS DATE)) + 1 AS e
  FROM ob
),
expected AS (
  SELECT strftime(x, '%Y-%m-%dT%H') AS slot, x AS slot_start
  FROM (SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP) - INTERVAL 1 HOUR,
                                      INTERVAL 1 HOUR)) AS x FROM bounds) AS g
),
landed AS (
  SELECT DISTINCT strftime(timestamp_received
    + CASE WHEN hour(timestamp_received) = 5 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END, '%Y-%m-%dT%H') AS slot
  FROM ob)"""

SQL["hour_slots"] = with_ctes(["ob"], "SELECT slot, slot_start FROM expected", extra=SLOTS)
SQL["missing_slots"] = with_ctes(["ob"], """
SELECT e.slot, e.slot_start FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.slot = e.slot)""", extra=SLOTS)
SQL["slot_completeness"] = with_ctes(["ob"], """
SELECT COUNT(*) AS total, count_if(ok) AS succeeded, count_if(NOT ok) AS failed,
  COALESCE(list(slot ORDER BY slot) FILTER (WHERE NOT ok), []) AS failed_keys
FROM (SELECT e.slot, l.slot IS NOT NULL AS ok FROM expected e LEFT JOIN landed l ON e.slot = l.slot)
  AS s""", bigint_cols=["succeeded", "failed"], extra=SLOTS)

SQL["date_slots"] = with_ctes(["ob"], """
SELECT DISTINCT CAST(slot_start AS DATE) AS date FROM expected""", extra=SLOTS)

SQL["window_replace"] = with_ctes(["activity"], """
SELECT *, 'old' AS version FROM activity
WHERE NOT (date >= DATE '2024-01-10' AND date < DATE '2024-01-20')
UNION ALL
SELECT *, 'new' AS version FROM activity
WHERE date >= DATE '2024-01-10' AND date < DATE '2024-01-20' AND date <> DATE '2024-01-15'""",
                                  round_cols=["avg_spread"])

MERGE = """
keyed AS (SELECT *, CAST(substr(market_id, 2) AS BIGINT) AS k FROM dim),
target AS (SELECT * EXCLUDE (k) FROM keyed WHERE k % 3 = 0),
source AS (
  SELECT * EXCLUDE (k) FROM keyed WHERE k % 3 <> 0
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ('changed' AS question) FROM keyed WHERE k % 3 = 0 AND k % 5 = 0
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE (question || ' (dup)' AS question) FROM keyed WHERE k = 1
)"""

_NEW_ROWS = "SELECT s.* FROM source s ANTI JOIN target t ON t.market_id = s.market_id"
SQL["insert_only_merge"] = with_ctes(["dim"], f"SELECT * FROM target UNION ALL {_NEW_ROWS}", extra=MERGE)
SQL["merge_one_per_key"] = with_ctes(["dim"], f"""
SELECT * FROM target
UNION ALL
SELECT n.* FROM ({_NEW_ROWS}) AS n
WHERE n.question = (SELECT min(m.question) FROM source m WHERE m.market_id = n.market_id)""", extra=MERGE)

_NEW_IDS = "SELECT DISTINCT o.market_id FROM {ob} o ANTI JOIN dim d ON d.market_id = o.market_id WHERE o.market_id IS NOT NULL"
SQL["new_market_ids"] = with_ctes(["ob", "dim"], _NEW_IDS.format(ob="ob"))
SQL["new_market_ids_window"] = with_ctes(["ob", "dim"], _NEW_IDS.format(
    ob=f"(SELECT *, CAST(timestamp_received AS DATE) AS date FROM ob WHERE {_WINDOW})"))

# fixed values: the fixture's tags, and the platform's canonical ones (the last
# one listed wins)
TAGS = [("9001", "Weekly Rewards"), ("9002", ""), ("9003", "Hot Topics"), ("596", "Culture"), ("120", "Finance"),
        ("2", "Politics"), ("100265", "Geopolitics"), ("21", "Crypto"), ("100639", "Games"), ("1", "Sports"),
        ("1401", "Tech")]
CANONICAL = [("596", "Culture", "pop-culture"), ("120", "Finance", "finance"), ("2", "Politics", "politics"),
             ("100265", "Geopolitics", "geopolitics"), ("21", "Crypto", "crypto"), ("100639", "Games", "games"),
             ("1", "Sports", "sports"), ("1401", "Tech", "tech")]


def _tags_sql(n: str) -> str:
    items = ", ".join(
        f"CASE WHEN (({n}) >> {i}) & 1 = 1 THEN {{'id': {_q(tid)}, 'label': {_q(label)}}} END"
        for i, (tid, label) in enumerate(TAGS))
    return f"list_filter([{items}], lambda t: t IS NOT NULL)"


def _canon_sql() -> str:
    return "[" + ", ".join(f"{{'id': {_q(i)}, 'label': {_q(lab)}, 'slug': {_q(slug)}}}"
                           for i, lab, slug in CANONICAL) + "]"


def _pick_sql(tags: str, field: str) -> str:
    canon = (f"list_filter({_canon_sql()}, lambda c: "
             f"list_contains(list_transform({tags}, lambda t: t.id), c.id))[-1]")
    usable = (f"list_filter({tags}, lambda t: t.label IS NOT NULL AND t.label <> '' "
              f"AND NOT contains(lower(t.label), 'rewards'))[1].label")
    if field == "category":
        return f"COALESCE(({canon}).label, {usable}, 'Unknown')"
    return f"COALESCE(({canon}).slug, replace(lower({usable}), ' ', '-'), 'unknown')"


SQL["pick_category"] = f"""
WITH tagged AS (
  SELECT 'm' || CAST(c_custkey AS VARCHAR) AS market_id, {_tags_sql('c_custkey')} AS tags
  FROM customer
)
SELECT market_id, {_pick_sql('tags', 'category')} AS category,
  {_pick_sql('tags', 'slug')} AS category_slug
FROM tagged"""


def _sanitize_sql(x: str) -> str:
    breaks = "'[' || chr(10) || chr(13) || chr(8232) || chr(8233) || ']+'"
    step1 = f"trim(regexp_replace({x}, {breaks}, ' ', 'g'))"
    ascii_only = f"regexp_replace(strip_accents({step1}), '[^\\x01-\\x7F]', '', 'g')"
    return f"trim(regexp_replace({ascii_only}, ' +', ' ', 'g'))"


SQL["sanitize_text"] = f"SELECT doc_id, {_sanitize_sql('text')} AS text FROM documents"

PAYLOAD = f"""
pay AS (
  SELECT
    CASE WHEN k % 5 = 0 THEN 'x' ELSE 'm' END || CAST(k AS VARCHAR) AS market_id,
    c_name AS question,
    CASE WHEN k % 6 <> 0 THEN
      {{'id': CASE WHEN k % 4 <> 0 THEN 'e' || CAST(k % 10 AS VARCHAR) END,
       'title': 'Évent ' || CAST(k % 10 AS VARCHAR) || chr(10), 'tags': {_tags_sql('k')}}} END AS ev,
    CASE WHEN k % 7 <> 0 THEN CASE WHEN k % 5 = 1 THEN '' ELSE
      strftime(DATE '2024-01-01' + CAST(k % 60 AS INTEGER), '%Y-%m-%d') END END AS iso_end,
    CASE WHEN k % 7 <> 0 THEN strftime(DATE '2024-01-01' + CAST(k % 45 AS INTEGER), '%Y-%m-%d')
      || 'T12:00:00Z' END AS other_end,
    CASE WHEN k % 8 <> 0 THEN c_acctbal < 0 END AS closed,
    [('resolved'), (''), (NULL)][k % 3 + 1] AS status,
    k % 8 AS statuses
  FROM (SELECT *, c_custkey AS k FROM customer)
)"""

SQL["landed_payload"] = f"""WITH {PAYLOAD}
SELECT market_id AS "conditionId", question, CAST(ev IS NOT NULL AS BIGINT) AS events, ev.id AS event_id,
  ev.title AS event_title, iso_end AS "endDateIso", other_end AS "endDate", closed, status AS "umaResolutionStatus",
  CASE WHEN statuses IN (0, 1) THEN TRUE WHEN statuses IN (4, 5) THEN FALSE END AS statuses_are_a_list
FROM pay"""

ENRICH = f"""
target AS (SELECT market_id FROM dim WHERE CAST(substr(market_id, 2) AS BIGINT) % 3 = 0),
ids AS (SELECT DISTINCT o.market_id FROM ob o ANTI JOIN target t ON t.market_id = o.market_id
        WHERE o.market_id IS NOT NULL),
{PAYLOAD},
etags AS (
  SELECT CASE WHEN j < 8 THEN 'e' ELSE 'x' END || CAST(j AS VARCHAR) AS event_id, {_tags_sql('j * 113')} AS tags
  FROM (SELECT DISTINCT c_custkey % 10 AS j FROM customer) AS e
),
found AS (
  SELECT p.*, CASE WHEN length(p.ev.id) > 0 THEN ifnull(et.tags, []) ELSE ifnull(p.ev.tags, []) END AS tags,
    -- the list gives its first element, the text that looks like one is kept
    CASE WHEN length(p.status) > 0 THEN p.status WHEN p.statuses = 0 THEN 'disputed'
         WHEN p.statuses = 4 THEN '["disputed","resolved"]' END AS outcome
  FROM pay p LEFT JOIN etags et ON p.ev.id = et.event_id
)"""

SQL["ghost_fill"] = with_ctes(["ob", "dim"], f"""
SELECT
  i.market_id,
  CASE WHEN f.market_id IS NULL THEN 'Ghost Market - no API data'
       ELSE COALESCE(NULLIF({_sanitize_sql('f.question')}, ''), 'Unknown') END AS question,
  CASE WHEN f.market_id IS NULL THEN 'Unknown'
       ELSE COALESCE(NULLIF({_sanitize_sql('f.ev.title')}, ''), 'Unknown') END AS event_title,
  CASE WHEN f.market_id IS NULL THEN 'Unknown' ELSE {_pick_sql('f.tags', 'category')} END AS category,
  CASE WHEN f.market_id IS NULL THEN 'unknown' ELSE {_pick_sql('f.tags', 'slug')} END AS category_slug,
  strftime(TRY_CAST(substr(COALESCE(NULLIF(f.iso_end, ''), NULLIF(f.other_end, '')), 1, 10) AS DATE), '%Y-%m-%d')
    AS end_date,
  CASE WHEN f.market_id IS NOT NULL THEN ifnull(f.closed, FALSE) END AS closed,
  f.outcome AS resolution_status,
  f.market_id IS NULL AS is_ghost
FROM ids i LEFT JOIN found f ON i.market_id = f.market_id""", extra=ENRICH)


# -------------------------------------------------- repeated dimension rows
_REPEATED = """
named AS (SELECT * REPLACE (CASE WHEN CAST(substr(market_id, 2) AS BIGINT) % 23 <> 0 THEN market_id END AS market_id)
          FROM ticks),
twice AS (
  SELECT * FROM mk
  UNION ALL
  SELECT * REPLACE (CASE WHEN CAST(substr(market_id, 2) AS BIGINT) % 8 = 0 THEN question || ' (dup)' ELSE question END
    AS question) FROM mk WHERE CAST(substr(market_id, 2) AS BIGINT) % 4 = 0
),""" + _labelled("relabelled", "named", "twice")
SQL["market_history_repeated"] = with_ctes(
    ["ticks", "mk"], "SELECT * FROM rehistory", _HIST_DOUBLES,
    extra=_REPEATED + "," + _history("rehistory", "relabelled"))
SQL["category_activity_repeated"] = with_ctes(
    ["ticks", "mk"], "SELECT * FROM reactivity", ["avg_spread"], ["market_count"],
    extra=_REPEATED + "," + _activity("reactivity", "relabelled"))


# --------------------------------------------- tables: written and read back
SQL["raw_scan_window"] = with_ctes(["ob"], f"""
SELECT * FROM (SELECT timestamp_received, timestamp_created_at, market_id, update_type, data,
                      CAST(timestamp_received AS DATE) AS date FROM ob) AS r WHERE {_WINDOW}""")
SQL["overwritten_dates"] = with_ctes(["ob"], """
SELECT date, COUNT(*) AS row_count
FROM (SELECT CAST(timestamp_received AS DATE) AS date, CAST(substr(market_id, 2) AS BIGINT) AS k FROM ob) AS r
WHERE date NOT IN (DATE '2024-01-09', DATE '2024-01-10') OR k % 2 = 0
GROUP BY date""")
SQL["window_replace_table"] = SQL["window_replace"]
SQL["missing_slots_by_path"] = SQL["missing_slots"]
SQL["category_concentration_joined"] = SQL["category_concentration"]

# the length of a cut line does not depend on what is in it; a whole line is
# longer than that
_LINES = """
lines AS (
  SELECT CASE WHEN k % 9 = 0 THEN 40 WHEN k % 31 = 0 THEN 5 END AS quarantined_chars,
    CASE WHEN k % 5 = 0 THEN 'x' ELSE 'm' END || CAST(k AS VARCHAR) AS id
  FROM (SELECT c_custkey AS k FROM customer) AS c
)"""
SQL["quarantined_payload"] = f"""WITH {_LINES}
SELECT CASE WHEN quarantined_chars IS NULL THEN id END AS "conditionId",
  CAST(quarantined_chars AS BIGINT) AS quarantined_chars FROM lines"""
SQL["quality_payload"] = f"""WITH {_LINES}, n AS (SELECT COUNT(*) AS total, COUNT(quarantined_chars) AS bad FROM lines)
SELECT 'market_payload' AS "table", c.name AS "check", CAST(c.v AS BIGINT) AS violations, c.v = 0 AS passed,
  FALSE AS blocking
FROM n, LATERAL (VALUES ('payload has lines', CASE WHEN total = 0 THEN 1 ELSE 0 END),
  ('malformed share within its limit', CASE WHEN bad > total * 0.01 THEN 1 ELSE 0 END),
  ('lines are well-formed', bad)) AS c(name, v)"""

SQL["end_dates"] = """
SELECT 'm' || CAST(k AS VARCHAR) AS market_id,
  CASE CAST(k % 12 AS INTEGER)
    WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y/%m/%d') WHEN 2 THEN strftime(d, '%Y%m%d')
    WHEN 3 THEN strftime(d, '%m/%d/%Y') WHEN 4 THEN strftime(d, '%B %-d, %Y') WHEN 5 THEN strftime(d, '%-d %b %Y')
    WHEN 6 THEN strftime(d, '%Y-%m-%d') || 'T23:30:00Z' WHEN 7 THEN strftime(d, '%m/%d/%Y') || ' 23:30'
    WHEN 8 THEN strftime(d, '%a, %d %b %Y') || ' 23:30:00 GMT' WHEN 9 THEN strftime(d, '%Y.%m.%d')
    WHEN 10 THEN '23:30' ELSE 'Q1 ' || strftime(d, '%Y') END AS text,
  CASE WHEN k % 12 < 10 THEN d END AS end_date
FROM (SELECT c_custkey AS k, DATE '2024-01-01' + CAST(c_custkey % 366 AS INTEGER) AS d FROM customer) AS c"""

SQL["distinct_markets_range"] = with_ctes(["history"], """
SELECT category, COUNT(DISTINCT market_id) AS market_count, TRUE AS estimate_is_near
FROM history GROUP BY category""")


# ------------------------------------------------------------------- tiles
SQL["daily_ticks"] = with_ctes(["activity"], """
SELECT date, SUM(tick_count) AS tick_count FROM activity GROUP BY date""",
                               bigint_cols=["tick_count"])
SQL["category_daily_ticks"] = with_ctes(["activity"], """
SELECT date, SUM(tick_count) AS tick_count FROM activity WHERE category = 'MACHINERY'
GROUP BY date""", bigint_cols=["tick_count"])
SQL["category_share"] = with_ctes(["activity"], """
SELECT date, category, tick_count,
  tick_count / SUM(tick_count) OVER (PARTITION BY date) AS tick_share
FROM activity""", round_cols=["tick_share"])
SQL["spread_heartbeat"] = with_ctes(["over_time"], """
SELECT date, "hour", avg_spread, tick_count FROM over_time""", round_cols=["avg_spread"])
SQL["tier_share"] = with_ctes(["distribution"], """
SELECT date, spread_tier, tick_count,
  tick_count / SUM(tick_count) OVER (PARTITION BY date) AS tick_share
FROM distribution""", round_cols=["tick_share"])
SQL["market_lifecycle"] = with_ctes(["history"], """
SELECT date, market_id, question, yes_avg_bid, tick_count FROM history
WHERE question = 'Customer#000000001'""", round_cols=["yes_avg_bid"])
SQL["expiry_segmentation"] = with_ctes(["expiry"], """
SELECT expiry_bucket, expiry_bucket_order, SUM(market_count) AS market_days,
  SUM(total_tick_count) AS tick_count
FROM expiry GROUP BY 1, 2""", bigint_cols=["market_days", "tick_count"])
SQL["concentration_heatmap"] = with_ctes(["conc"], """
SELECT date, category, active_markets, top_market_share, top_3_market_share, hhi_concentration_index
FROM heads JOIN totals USING (date, category)""", round_cols=[
    "top_market_share", "top_3_market_share", "hhi_concentration_index"],
    bigint_cols=["active_markets"])
SQL["market_share_drilldown"] = with_ctes(["conc"], """
SELECT date, market_id, question, market_tick_count, market_tick_share, market_rank_in_category
FROM shared WHERE category = 'MACHINERY'""", ["market_tick_share"], ["market_rank_in_category"])
SQL["category_pie"] = with_ctes(["activity"], """
SELECT category, SUM(tick_count) AS tick_count,
  SUM(tick_count) / (SELECT SUM(tick_count) FROM activity) AS tick_share
FROM activity GROUP BY category""", round_cols=["tick_share"], bigint_cols=["tick_count"])
