"""Tick transform: guards, JSON edge cases, casts, windows (traps T3, T6, PF5-PF9)."""

import datetime as dt
import json

import pytest

from tickstat import schemas as S
from tickstat.operators import reports as R
from tickstat.operators import ticks as K

TS = dt.datetime(2024, 3, 14, 10, 30, 5, tzinfo=dt.timezone.utc)


def book(spark, rows):
    """rows: (update_type, payload dict or raw text, ts)"""
    data = []
    for update, payload, ts in rows:
        text = payload if isinstance(payload, str) else json.dumps(payload)
        data.append((ts or TS, ts or TS, "0xabc", update, text))
    return spark.createDataFrame(data, S.RAW_ORDERBOOK)


def pc(bid="0.014", ask="0.016", side="YES", **extra):
    d = {"update_type": "price_change", "token_id": "445", "side": side, "best_bid": bid,
         "best_ask": ask, "change_size": "0", "change_side": "SELL"}
    d.update(extra)
    return {k: v for k, v in d.items() if v is not None}


def test_sample_row_is_kept(spark):
    out = K.price_changes(book(spark, [("price_change", pc(), None)])).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.best_bid, r.best_ask, r.change_size, r.token_id, r.side) == (0.014, 0.016, 0.0, "445", "YES")
    assert r.spread == pytest.approx(0.002)
    assert r.date == dt.date(2024, 3, 14)


@pytest.mark.parametrize("payload", [
    pc(bid=None), pc(ask=None), pc(side="MAYBE"), pc(side=None), pc(bid="1.2"),
    pc(ask="-0.01"), pc(bid="0.5", ask="0.4"), pc(bid="NaN"), pc(bid="abc"),
    "{not json", "[1, 2]", pc(bid=None, ask=None),
])
def test_rejected(spark, payload):
    assert K.price_changes(book(spark, [("price_change", payload, None)])).count() == 0


def test_numbers_as_json_numbers_are_read(spark):
    raw = '{"side": "NO", "best_bid": 0.10, "best_ask": 0.2}'
    r = K.price_changes(book(spark, [("price_change", raw, None)])).first()
    assert (r.best_bid, r.best_ask, r.side) == (0.1, 0.2, "NO")


def test_bounds_inclusive_and_equal_prices(spark):
    rows = [("price_change", pc(bid="0", ask="0"), None), ("price_change", pc(bid="1", ask="1"), None)]
    assert K.price_changes(book(spark, rows)).count() == 2


def test_snapshots_are_ignored(spark):
    rows = [("book_snapshot", '[{"price": "0.5", "size": "10"}]', None)]
    assert K.price_changes(book(spark, rows)).count() == 0


def test_strict_cast_raises(spark):
    df = K.price_changes(book(spark, [("price_change", pc(bid="abc"), None)]), strict=True)
    with pytest.raises(Exception):
        df.collect()


def test_half_open_window(spark):
    day = lambda d: dt.datetime(2024, 1, d, 23, 59, 59, tzinfo=dt.timezone.utc)
    rows = [("price_change", pc(), day(d)) for d in (1, 2, 3)]
    out = K.price_changes(book(spark, rows), "2024-01-02", "2024-01-03").collect()
    assert [r.date for r in out] == [dt.date(2024, 1, 2)]


def test_reject_report_counts(spark):
    rows = [("price_change", p, None) for p in
            (pc(), pc(bid=None), pc(side="X"), pc(bid="abc"), pc(bid="0.6", ask="0.5"), pc(ask="2"))]
    r = K.reject_report(book(spark, rows)).first()
    assert r.price_change_rows == 6 and r.kept == 1 and r.rejected == 5
    assert (r.missing_bid, r.bad_side, r.unparsable_bid, r.inverted, r.ask_out_of_bounds) == (1, 1, 1, 1, 1)


def test_float_threshold_stays_double(spark):
    # 0.05 - 0.03 is 0.020000000000000004 in float64, so it is Medium although
    # the decimal difference is 0.02 (T6); an exact 0.02 is Tight (<=, T4).
    rows = [("price_change", pc(bid="0.03", ask="0.05"), None),
            ("price_change", pc(bid="0", ask="0.02"), None)]
    ticks = K.price_changes(book(spark, rows))
    tiers = sorted((r.spread_tier, r.tick_count) for r in R.spread_distribution(ticks).collect())
    assert tiers == [(S.TIER_TIGHT, 1), (S.TIER_MEDIUM, 1)]


def test_payload_parsed_once(spark):
    df = K.price_changes(book(spark, [("price_change", pc(), None)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("json_tuple") == 1
    assert "get_json_object" not in plan and "from_json" not in plan


def test_nested_values_read_as_null(spark):
    rows = [("price_change", '{"side": "YES", "best_bid": "0.1", "best_ask": "0.2", "token_id": {"a": 1}}', None),
            ("price_change", '{"side": "YES", "best_bid": "0.1", "best_ask": "0.2", "token_id": "{abc"}', None),
            ("price_change", '{"side": "YES", "best_bid": [0.1], "best_ask": "0.2"}', None),
            ("price_change", '{"side": ["YES"], "best_bid": "0.1", "best_ask": "0.2"}', None)]
    out = K.price_changes(book(spark, rows)).collect()
    assert sorted((r.token_id or "<null>") for r in out) == ["<null>", "{abc"]
    rep = K.reject_report(book(spark, rows)).first()
    assert (rep.missing_bid, rep.unparsable_bid, rep.bad_side, rep.kept) == (1, 0, 1, 2)
