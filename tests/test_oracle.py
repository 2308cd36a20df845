"""Every registered query against its SQL oracle (the driver's gate, at sf0.001)."""

import pytest

import __spark_entry__ as E
from compare import compare
from conftest import SF_SMALL

QUERIES = E.queries()
SQL = E.oracle_sql()


def test_every_query_has_an_oracle():
    # the operators on documents have their own tests
    own = {name for name in QUERIES if not name.startswith("op") and name != "pipeline"}
    assert own <= set(SQL) <= set(QUERIES)


def test_quality_queries_find_violations(spark):
    for name in ("quality_orderbook", "quality_ticks", "quality_markets", "quality_facts"):
        assert any(not r.passed for r in QUERIES[name](spark, SF_SMALL).collect()), name
    assert QUERIES["missing_slots"](spark, SF_SMALL).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck_small, name):
    res = compare(QUERIES[name](spark, SF_SMALL), duck_small, SQL[name])
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "price_trend_corr" in df.columns
