"""Property: the table writer (staged per-date swap) leaves exactly what the
DataFrame model of delete+insert describes, for random tables and windows."""

import datetime as dt
import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st

from tickstat.operators import sinks as SK

DAY0 = dt.date(2024, 1, 1)
days = st.integers(min_value=0, max_value=9)


def frame(spark, offsets, tag):
    rows = [(DAY0 + dt.timedelta(days=o), tag, i) for i, o in enumerate(offsets)]
    return spark.createDataFrame(rows, "date date, tag string, n int")


def content(df):
    return sorted((str(r.date), r.tag, r.n) for r in df.collect())


@settings(max_examples=int(os.environ.get("PROP_EXAMPLES", "6")), deadline=None)
@given(existing=st.lists(days, max_size=8), fresh=st.lists(days, max_size=6),
       start=days, length=st.integers(min_value=0, max_value=5))
def test_write_window_matches_model(spark, existing, fresh, start, length):
    w_start, w_end = DAY0 + dt.timedelta(days=start), DAY0 + dt.timedelta(days=start + length)
    old, new = frame(spark, existing, "old"), frame(spark, fresh, "new")
    path = tempfile.mkdtemp(prefix="ts-prop-") + "/t"
    if existing:
        SK.overwrite_partitions(old, path)
    emptied = SK.write_window(new, path, w_start, w_end)
    model = content(SK.window_replace(old, new, w_start, w_end))
    got = content(spark.read.schema("tag string, n int, date date").parquet(path)) \
        if (existing or fresh) else []
    assert got == model
    in_window = {DAY0 + dt.timedelta(days=o) for o in existing if start <= o < start + length}
    fresh_days = {DAY0 + dt.timedelta(days=o) for o in fresh}
    assert set(emptied) == in_window - fresh_days


keys = st.sampled_from(["a", "b", "c", "d", "e"])
vals = st.sampled_from(["x", "y", "z"])


@settings(max_examples=int(os.environ.get("PROP_EXAMPLES", "6")), deadline=None)
@given(target=st.dictionaries(keys, vals, max_size=4),
       source=st.lists(st.tuples(keys, vals), max_size=8))
def test_insert_only_merge_matches_model(spark, target, source):
    schema = "k string, v string"
    t = spark.createDataFrame(sorted(target.items()), schema)
    s = spark.createDataFrame(source, schema)
    model = dict(target)
    for k, v in sorted(source):                  # smallest source row per new key
        if k not in target and k not in model:
            model[k] = v
    got = sorted((r.k, r.v) for r in SK.insert_only_merge(t, s, "k", dedup=True).collect())
    assert got == sorted(model.items())
    fanned = sorted((r.k, r.v) for r in SK.insert_only_merge(t, s, "k", dedup=False).collect())
    assert fanned == sorted(list(target.items()) + [(k, v) for k, v in source if k not in target])
