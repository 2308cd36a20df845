"""Every rule kind with a passing and a failing input; the gate."""

import pytest
from pyspark.sql import functions as F

from tickstat.operators import quality as Q


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [("2024-01-01", "a", 1, 0.5), ("2024-01-01", "b", 2, 0.0), ("2024-01-02", "a", 3, 1.0)],
        "date string, k string, n long, x double").withColumn("date", F.col("date").cast("date"))


def cases():
    return [
    (Q.not_null("k"), Q.not_null("missing_is_null")),
    (Q.positive("n"), Q.positive("x")),
    (Q.non_negative("x"), Q.violations("neg", F.col("x") - 1 < 0)),
    (Q.max_("x", 1.0), Q.max_("x", 0.9)),
    (Q.non_empty(), None),
    (Q.values_present("k", ["a", "b"]), Q.values_present("k", ["a", "z"])),
    (Q.ratio_at_most("r", F.col("k") == "b", 0.5), Q.ratio_at_most("r2", F.col("k") == "a", 0.5)),
    (Q.unique("date", "k"), Q.unique("k")),
    (Q.max_per_group("per date", ["date"], 2), Q.max_per_group("per date", ["date"], 1)),
    (Q.group_sum_near("sum", "x", ["date"], 1.0, 0.6), Q.group_sum_near("sum", "x", ["date"], 1.0, 1e-4)),
    ]


@pytest.mark.parametrize("i", range(10))
def test_rule_pass_and_fail(spark, df, i):
    good, bad = cases()[i]
    data = df.withColumn("missing_is_null", F.lit(None).cast("string"))
    rows = Q.quality_report(data, [good] + ([bad] if bad else [])).collect()
    assert rows[0].passed and rows[0].violations == 0
    if bad:
        assert not rows[1].passed and rows[1].violations > 0


def test_empty_window_fails_non_empty_and_warns_cardinality(spark, df):
    rows = Q.quality_report(df, [Q.non_empty(), Q.max_per_group("c", ["date"], 3)],
                            start="2030-01-01", end="2030-01-02").collect()
    assert [r.passed for r in rows] == [False, False]


def test_gate_raises_on_blocking_only(spark, df):
    warn = Q.quality_report(df, [Q.max_("x", 0.1, blocking=False)])
    assert len(Q.gate(warn)) == 1
    with pytest.raises(Q.QualityError):
        Q.gate(Q.quality_report(df, [Q.max_("x", 0.1)]))


def test_single_pass(spark, df):
    rep = Q.quality_report(df, [Q.not_null("k"), Q.positive("n"), Q.max_("x", 1.0)])
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_empty_dates(spark, df):
    out = [str(r.date) for r in Q.empty_dates(df, "2023-12-31", "2024-01-04").orderBy("date").collect()]
    assert out == ["2023-12-31", "2024-01-03"]


def test_observed_rules_match_report(spark, df):
    rules = [Q.not_null("k"), Q.positive("n"), Q.max_("x", 0.9), Q.non_empty(), Q.values_present("k", ["a", "z"])]
    observed, finish = Q.observe_rules(df, rules, table="t")
    observed.where(F.col("n") > 100).write.format("noop").mode("overwrite").save()   # filter after observe
    got = finish()
    want = [r.asDict() for r in Q.quality_report(df, rules, table="t").collect()]
    assert got == want
    with pytest.raises(ValueError):
        Q.observe_rules(df, [Q.Rule("x", "no such kind", keys=("k",))])


def grouped_rules():
    return [Q.unique("k"), Q.unique("date", "k"), Q.max_per_group("per date", ["date"], 1),
            Q.max_per_group("per key", ["k"], 2), Q.group_sum_near("sums", "x", ["date"], 1.0, 0.4),
            Q.group_sum_near("sums of keys", "n", ["k"], 2.0, 0.5), Q.not_null("k")]


def with_null_keys(df):
    """A NULL key is a group, also beside sets of keys that leave it out."""
    return df.unionByName(df.where("n = 2").withColumn("k", F.lit(None).cast("string")))


def test_grouped_rules_share_one_pass(spark, df):
    data = with_null_keys(df)
    report = Q.quality_report(data, grouped_rules())
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Relation") + plan.count("LogicalRDD") <= 2 * 2
    got = {r.check: r.violations for r in report.collect()}
    one_by_one = {r.name: Q.quality_report(data, [r]).first().violations for r in grouped_rules()}
    assert got == one_by_one
    assert got["k: unique"] == 1 and got["date, k: unique"] == 0 and got["per date"] == 1 and got["k: not_null"] == 1


def test_grouped_rules_are_observed(spark, df):
    data = with_null_keys(df)
    for rows in (data, data.where("n > 100")):
        observed, finish = Q.observe_rules(rows, grouped_rules(), table="t")
        assert observed.columns == rows.columns
        observed.write.format("noop").mode("overwrite").save()
        want = {r.check: r.violations for r in Q.quality_report(rows, grouped_rules(), table="t").collect()}
        assert {r["check"]: r["violations"] for r in finish()} == want


def test_rows_that_carry_their_groups_value(spark, df):
    per = df.groupBy("date").agg(F.sum("x").alias("s"), F.min("n").alias("first")).withColumnRenamed("date", "day")
    rows = df.join(per, F.col("date") == F.col("day"))
    rule = Q.group_sum_near("sums", "x", ["date"], 1.0, 0.4)
    observed, finish = Q.observe_rules(rows, [rule], given={"sums": (F.col("s"), F.col("n") == F.col("first"))})
    observed.write.format("noop").mode("overwrite").save()
    assert [r["violations"] for r in finish()] == [Q.quality_report(df, [rule]).first().violations] == [1]
