"""Enrichment: category choice (T1, T13), sanitizing (F16), ghosts (T2, T14), merge (T8)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickstat import schemas as S
from tickstat.functions.category import pick_category
from tickstat.functions.text import sanitize_text
from tickstat.operators import markets as M
from tickstat.operators import sinks as SK


def picked(spark, tags, first_wins=False):
    df = spark.createDataFrame([(tags,)], "tags array<struct<id:string,label:string>>")
    r = df.select(pick_category(F.col("tags"), first_wins).alias("p")).first().p
    return r.category, r.category_slug


def test_last_listed_canonical_tag_wins(spark):
    tags = [("2", "Politics"), ("596", "Culture")]
    assert picked(spark, tags) == ("Politics", "politics")
    assert picked(spark, tags, first_wins=True) == ("Culture", "pop-culture")
    assert picked(spark, [("1401", "x"), ("1", "y")]) == ("Tech", "tech")


def test_fallback_and_unknown(spark):
    assert picked(spark, [("7", "Daily Rewards"), ("8", ""), ("9", "Pop Stars")]) == ("Pop Stars", "pop-stars")
    assert picked(spark, [("7", "REWARDS")]) == ("Unknown", "unknown")
    assert picked(spark, []) == ("Unknown", "unknown")


@pytest.mark.parametrize("raw,clean", [
    ("  Café\nau  lait x  ", "Cafe au lait x"), ("日本 text", "text"), ("", ""),
    ("a\r\n\r\nb", "a b"), ("Ünïcödé", "Unicode"), ("\t 中\t x\u2028\u2029y \x1f", "x y"),
    ("plain  ascii\ttab", "plain ascii\ttab"),
])
def test_sanitize(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(sanitize_text("t").alias("c")).first().c == clean


def test_sanitize_keeps_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(sanitize_text("t").alias("c")).first().c is None


def _payload(spark, rows):
    """Rows of market objects; the last field as JSON text, typed on reading."""
    names = S.MARKET_PAYLOAD.fieldNames()
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name == names[-1] else f.dataType)
                         for f in S.MARKET_PAYLOAD])
    return spark.createDataFrame(rows, text).withColumn(names[-1], F.parse_json(names[-1]))


@pytest.mark.parametrize("single,many,status", [
    (None, '["disputed", "resolved"]', "disputed"), (None, '"[\\"disputed\\"]"', '["disputed"]'),
    (None, "[]", None), (None, '"[]"', None), (None, '""', None), (None, '"open"', "open"), (None, None, None),
    ("", '["a"]', "a"), ("single", '["a"]', "single"), (None, "null", None), (None, '{"a": 1}', None)])
def test_resolution_status_by_type(spark, single, many, status):
    df = spark.createDataFrame([(single, many)], "single string, many string")
    got = df.select(M._resolution_status(F.col("single"), F.parse_json("many")).alias("s")).first().s
    assert got == status


def test_repeated_event_lookups_do_not_multiply(spark):
    ids = spark.createDataFrame([("m1",)], "market_id string")
    payload = _payload(spark, [("m1", "q", [("e1", "t", [])], None, None, None, None, None)])
    tags = spark.createDataFrame([("e1", [("1", "Sports")])] * 3, S.EVENT_TAGS)
    assert [r.category for r in M.enrich_markets(ids, payload, tags).collect()] == ["Sports"]


def test_a_time_without_a_date_is_junk(spark):
    dim = spark.createDataFrame([("a", "q", "e", None, None, "12:30", False, None, False)], S.DIM_MARKETS)
    assert M.markets_view(dim).first().end_date is None
    payload = _payload(spark, [("a", "q", [], "12:30", None, None, None, None)])
    out = M.enrich_markets(dim.select("market_id"), payload, spark.createDataFrame([], S.EVENT_TAGS)).first()
    assert out.end_date is None and not out.is_ghost


def test_enrich_ghosts_tags_and_fields(spark):
    ids = spark.createDataFrame([("m1",), ("m2",), ("m3",), ("ghost",)], "market_id string")
    ev = lambda i, tags: [(i, "Évent\n title", tags)]
    payload = _payload(spark, [
        ("m1", " Will\nX? ", ev("e1", [("596", "Culture")]), "2024-03-01", None, None, "", '["resolved"]'),
        ("m2", "", ev(None, [("21", "Crypto")]), "", "2024-05-06T23:00:00Z", True, "proposed", None),
        ("m3", None, ev("e9", [("21", "Crypto")]), "garbage", None, False, None, "[]"),
    ])
    tags = spark.createDataFrame([("e1", [("2", "Politics"), ("1", "Sports")])], S.EVENT_TAGS)
    out = {r.market_id: r for r in M.enrich_markets(ids, payload, tags).collect()}
    m1, m2, m3, g = out["m1"], out["m2"], out["m3"], out["ghost"]
    # event with an id: tags from the tag lookup only (payload tags ignored)
    assert (m1.category, m1.question, m1.event_title) == ("Sports", "Will X?", "Event title")
    assert (m1.end_date, m1.closed, m1.resolution_status, m1.is_ghost) == ("2024-03-01", False, "resolved", False)
    # event without an id: its own tags; second end-date field; empty question defaults
    assert (m2.category, m2.question, m2.end_date, m2.resolution_status) == ("Crypto", "Unknown", "2024-05-06", "proposed")
    # id whose tag lookup failed: no tags at all; junk date -> NULL; '[]' -> NULL
    assert (m3.category, m3.end_date, m3.resolution_status, m3.question) == ("Unknown", None, None, "Unknown")
    assert (g.is_ghost, g.question, g.category, g.closed, g.end_date) == (True, S.GHOST_QUESTION, "Unknown", None, None)


def test_new_ids_and_ghosts_are_sticky(spark):
    ob = spark.createDataFrame([("m1",), ("m2",), ("m2",), (None,)], "market_id string") \
        .withColumn("timestamp_received", F.current_timestamp())
    dim = spark.createDataFrame([("m1", "Ghost", "Unknown", "Unknown", "unknown", None, None, None, True)],
                                S.DIM_MARKETS)
    assert [r.market_id for r in M.new_market_ids(ob, dim).collect()] == ["m2"]


def test_insert_only_merge_dedups_and_never_updates(spark):
    row = lambda i, q: (i, q, "e", None, None, None, False, None, False)
    target = spark.createDataFrame([row("a", "old")], S.DIM_MARKETS)
    source = spark.createDataFrame([row("a", "new"), row("b", "y"), row("b", "x")], S.DIM_MARKETS)
    out = sorted((r.market_id, r.question) for r in SK.insert_only_merge(target, source).collect())
    assert out == [("a", "old"), ("b", "x"), ("b", "y")]            # every unmatched row
    one = sorted((r.market_id, r.question) for r in SK.insert_only_merge(target, source, dedup=True).collect())
    assert one == [("a", "old"), ("b", "x")]


def test_landed_payload_round_trip(spark):
    import tempfile

    from conftest import SF_SMALL
    from tickstat.plans import registry as G
    from tickstat.sources import fixtures as FX
    from tickstat.sources.payload import read_event_tags, read_market_payload

    base = tempfile.mkdtemp(prefix="ts-payload-")
    customer = G.table(spark, SF_SMALL, "customer")
    FX.market_payload_from_customer(customer).write.json(f"{base}/markets")
    FX.event_tags_from_customer(customer).write.json(f"{base}/tags")
    with open(f"{base}/markets/extra.json", "w") as f:      # a list-valued status, a bad line
        f.write('{"conditionId": "x1", "question": "Q", "umaResolutionStatuses": ["a", "b"]}\n')
        f.write('{not json\n')
    payload = read_market_payload(spark, f"{base}/markets")
    tags = read_event_tags(spark, f"{base}/tags")
    ids = spark.createDataFrame([("x1",), ("m1",), ("m5",)], "market_id string")
    out = {r.market_id: r for r in M.enrich_markets(ids, payload, tags).collect()}
    assert out["x1"].resolution_status == "a" and not out["x1"].is_ghost
    assert out["m5"].is_ghost and not out["m1"].is_ghost
    direct = {r.market_id: r for r in M.enrich_markets(
        ids, FX.market_payload_from_customer(customer), FX.event_tags_from_customer(customer)).collect()}
    assert out["m1"] == direct["m1"]


def test_end_dates_parse_per_row(spark):
    # T5: date and datetime text mixed in one column both parse (no per-batch format)
    rows = [("a", "2024-03-01", None), ("b", "2024-03-02T10:00:00Z", None), ("c", None, "2024-03-03 23:30:00"),
            ("d", "", "2024-03-04T01:00:00+05:00"), ("e", "not a date", None), ("f", "2024-02-30", None)]
    payload = _payload(spark, [(i, "q", [], iso, other, False, None, None) for i, iso, other in rows])
    ids = spark.createDataFrame([(r[0],) for r in rows], "market_id string")
    tags = spark.createDataFrame([], S.EVENT_TAGS)
    got = {r.market_id: r.end_date for r in M.enrich_markets(ids, payload, tags).collect()}
    assert got == {"a": "2024-03-01", "b": "2024-03-02", "c": "2024-03-03", "d": "2024-03-04",
                   "e": None, "f": None}


def test_retry_ghosts(spark):
    row = lambda i, q, ghost: (i, q, "e", None, None, None, None if ghost else False, None, ghost)
    dim = spark.createDataFrame([row("g", S.GHOST_QUESTION, True), row("k", "kept", False),
                                 row("g2", S.GHOST_QUESTION, True)], S.DIM_MARKETS)
    ob = spark.createDataFrame([("g",), ("k",), ("g2",), ("n",)], "market_id string") \
        .withColumn("timestamp_received", F.current_timestamp())
    assert sorted(r.market_id for r in M.new_market_ids(ob, dim).collect()) == ["n"]
    retry = sorted(r.market_id for r in M.new_market_ids(ob, dim, retry_ghosts=True).collect())
    assert retry == ["g", "g2", "n"]
    enriched = spark.createDataFrame([row("g", "found now", False), row("g2", S.GHOST_QUESTION, True),
                                      row("n", "new", False)], S.DIM_MARKETS)
    out = {r.market_id: r.question for r in M.resolve_ghosts(dim, enriched).collect()}
    assert out == {"g": "found now", "k": "kept", "g2": S.GHOST_QUESTION}


def test_segmentation_dispatch(spark):
    from tickstat.operators import tiles as DT
    exp = spark.createDataFrame([("2024-01-01", "0-1d", 1, 2, 5)],
                                "date string, expiry_bucket string, expiry_bucket_order int, market_count long, total_tick_count long")
    assert DT.segmentation(exp).first().tick_count == 5


WRITTEN = {
    "2026-03-14": "2026-03-14", "2026-3-4": "2026-03-04", " 2026-03-14 ": "2026-03-14", "2026-03-14T23:59:59Z": "2026-03-14",
    "2026-03-14T23:00:00-05:00": "2026-03-14", "2026-03-14 08:00": "2026-03-14", "2026/03/14": "2026-03-14",
    "2026.03.14": "2026-03-14", "20260314": "2026-03-14", "03/14/2026": "2026-03-14", "14/03/2026": "2026-03-14",
    "3/4/2026": "2026-03-04", "03-14-2026": "2026-03-14", "14-03-2026": "2026-03-14", "03/14/2026 5:30 PM": "2026-03-14",
    "03/14/2026, 17:30:05 UTC": "2026-03-14", "March 14, 2026": "2026-03-14", "MARCH 14 2026": "2026-03-14",
    "Mar 14th, 2026": "2026-03-14", "Sept. 3, 2026": "2026-09-03", "14 March 2026": "2026-03-14", "14-Mar-2026": "2026-03-14",
    "Sat, 14 Mar 2026 12:00:00 GMT": "2026-03-14", "Saturday, March 14, 2026 at 5:00 pm": "2026-03-14",
    "12:30": None, "soon": None, "2026": None, "13/13/2026": None, "20261399": None, "Q1 2026": None, "2026-02-30": None,
    "Foo 14, 2026": None, "": None, "2026-03-14 or later": None,
}


def test_dates_as_they_are_written(spark):
    from tickstat.functions.columns import written_date
    rows = spark.createDataFrame([(t,) for t in WRITTEN] + [(None,)], "t string")
    got = {r.t: r.d and r.d.isoformat() for r in rows.select("t", written_date("t").alias("d")).collect()}
    assert got == WRITTEN | {None: None}


def test_each_row_is_read_by_itself(spark):
    """The way one row is written does not matter for another."""
    from tickstat.operators import markets as M
    from tickstat import schemas as S
    texts = ["March 14, 2026", "2026-03-14T12:00:00Z", None, "", "whenever", "03/15/2026"]
    payload = spark.createDataFrame([(f"m{i}", "q", None, t, None, False, None) for i, t in enumerate(texts)],
                                    "conditionId string, question string, events string, endDateIso string, endDate string, "
                                    "closed boolean, umaResolutionStatus string") \
        .withColumns({"events": F.lit(None).cast(S.MARKET_PAYLOAD["events"].dataType),
                      "umaResolutionStatuses": F.parse_json(F.lit(None).cast("string"))})
    ids = payload.select(F.col("conditionId").alias("market_id"))
    tags = spark.createDataFrame([], S.EVENT_TAGS)
    got = {r.market_id: r.end_date for r in M.enrich_markets(ids, payload, tags).collect()}
    assert [got[f"m{i}"] for i in range(6)] == ["2026-03-14", "2026-03-14", None, None, None, "2026-03-15"]
    report = M.end_date_report(payload).first()
    assert tuple(report) == (6, 4, 3, 1)
