"""Dates of a catalog table are replaced as a whole, wherever a run stops."""

import datetime as dt
import os
import tempfile

import pytest

from tickstat.operators import catalog as C
from tickstat.operators import sinks as SK


def fact(spark, dates, tag, n=3):
    return spark.createDataFrame([(dt.date.fromisoformat(d), tag, i) for d in dates for i in range(n)],
                                 "date date, tag string, n int")


@pytest.fixture
def table(spark):
    name = f"fact_{os.path.basename(tempfile.mktemp()).replace('-', '_')}"
    C.ensure_catalog_table(spark, name, fact(spark, [], "").schema, tempfile.mkdtemp(prefix="ts-cat-") + "/t")
    yield name
    spark.sql(f"DROP TABLE {name}")


def tags(spark, name):
    """What each date holds: its tags and number of rows."""
    out = {}
    for r in spark.table(name).collect():
        out.setdefault(str(r.date), []).append(r.tag)
    return {d: ("".join(sorted(set(t))), len(t)) for d, t in out.items()}


def test_replace_and_empty_dates(spark, table):
    C.replace_partitions(fact(spark, ["2024-01-09", "2024-01-10", "2024-01-11"], "a"), table, "2024-01-09", "2024-01-12")
    emptied = C.replace_partitions(fact(spark, ["2024-01-10"], "b", 2), table, "2024-01-10", "2024-01-12")
    assert emptied == [dt.date(2024, 1, 11)]
    assert tags(spark, table) == {"2024-01-09": ("a", 3), "2024-01-10": ("b", 2)}
    C.replace_partitions(fact(spark, ["2024-01-10"], "b", 2), table, "2024-01-10", "2024-01-12")       # again
    assert tags(spark, table) == {"2024-01-09": ("a", 3), "2024-01-10": ("b", 2)}
    plan = C.read_partitions(spark, table, "2024-01-10", "2024-01-11")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-10" in plan
    assert not C.ensure_catalog_table(spark, table, spark.table(table).schema, "/nowhere")


def test_a_table_can_be_replaced_by_what_it_holds(spark, table):
    C.replace_partitions(fact(spark, ["2024-01-09"], "a"), table, "2024-01-09", "2024-01-10")
    C.replace_partitions(spark.table(table).selectExpr("date", "concat(tag, 'a') AS tag", "n"), table,
                         "2024-01-09", "2024-01-10")
    assert tags(spark, table) == {"2024-01-09": ("aa", 3)}


def test_rows_outside_the_window_are_refused(spark, table):
    C.replace_partitions(fact(spark, ["2024-01-09"], "a"), table, "2024-01-09", "2024-01-10")
    with pytest.raises(ValueError, match="2024-01-11"):
        C.replace_partitions(fact(spark, ["2024-01-09", "2024-01-11"], "b"), table, "2024-01-09", "2024-01-10")
    assert tags(spark, table) == {"2024-01-09": ("a", 3)}


@pytest.mark.parametrize("stop", range(5))
def test_stopped_between_any_two_calls(spark, table, monkeypatch, stop):
    days = [f"2024-01-{d:02d}" for d in range(9, 13)]
    C.replace_partitions(fact(spark, days[:3], "old", 3), table, "2024-01-09", "2024-01-13")
    real, calls = C._point, []

    class Stopped(BaseException):
        pass

    def point(*args):
        if len(calls) == stop:
            raise Stopped
        calls.append(args)
        real(*args)

    monkeypatch.setattr(C, "_point", point)
    fresh = fact(spark, [days[0], days[2], days[3]], "new", 5)           # one date is emptied, one is added
    try:
        C.replace_partitions(fresh, table, "2024-01-09", "2024-01-13")
    except Stopped:
        pass
    monkeypatch.undo()
    old = {days[0]: ("old", 3), days[1]: ("old", 3), days[2]: ("old", 3)}
    new = {days[0]: ("new", 5), days[2]: ("new", 5), days[3]: ("new", 5)}
    assert tags(spark, table) == {d: s[d] for i, d in enumerate(days) for s in [new if i < stop else old] if d in s}
    C.replace_partitions(fresh, table, "2024-01-09", "2024-01-13")
    assert tags(spark, table) == new


def test_vacuum_keeps_what_is_pointed_at(spark, table):
    for tag in "abc":
        C.replace_partitions(fact(spark, ["2024-01-09", "2024-01-10"] if tag == "a" else ["2024-01-09"], tag), table,
                             "2024-01-09", "2024-01-10" if tag != "a" else "2024-01-11")
    assert C.vacuum(spark, table) == []                                  # all too young
    before = tags(spark, table)
    gone = C.vacuum(spark, table, keep_minutes=-1)
    assert len(gone) == 2 and all("date=2024-01-09" in g for g in gone)
    assert tags(spark, table) == before == {"2024-01-09": ("c", 3), "2024-01-10": ("a", 3)}
    root = C.table_location(spark, table)
    assert len(SK.glob(spark, f"{root}/{C.VERSIONS}/*")) == 2
