"""Declarative data-quality rules, evaluated as Spark aggregations.

A rule yields a number of violations; it passes at zero. Row-level rules
(not_null, positive, non_negative, max, constraint sets, non-empty, expected
values present, ratios) become ``count_if``-style aggregate expressions and
are **all evaluated in one aggregation pass** over the checked table (a global
aggregate: each task emits one partial row, so the pass is as parallel as the
scan). Rules that need a grouping (uniqueness, per-date cardinality, per-group
sums) share a second one, whatever they group by (GROUPING SETS). The report is
unpivoted to one row per rule; ``gate`` collects that report (one row per rule,
never data rows) and raises on a blocking failure.

``observe_rules`` evaluates the same rules on rows on their way into a table,
so that a table is not scanned only to be checked.

The per-asset rule sets reproduce the source's declared checks; windowed
checks take the same half-open date window as the transforms.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import in_window
from ..sources.payload import CORRUPT


class QualityError(RuntimeError):
    """A blocking rule failed."""


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str
    column: str | None = None
    value: object = None
    condition: Column | None = field(default=None, compare=False)
    keys: tuple = ()
    blocking: bool = True

    # ---- single-pass rules: one aggregate expression each
    def expr(self) -> Column | None:
        c = F.col(self.column) if self.column else None
        if self.kind == "not_null":
            return F.count_if(c.isNull())
        if self.kind == "positive":
            return F.count_if(c <= 0)
        if self.kind == "non_negative":
            return F.count_if(c < 0)
        if self.kind == "max":
            return F.count_if(c > F.lit(self.value))
        if self.kind == "violations":          # rows matching a bad-row condition
            return F.count_if(F.coalesce(self.condition, F.lit(False)))
        if self.kind == "non_empty":
            return F.when(F.count(F.lit(1)) > 0, 0).otherwise(1)
        if self.kind == "values_present":       # every expected value occurs
            return reduce(lambda a, b: a + b, [
                F.when(F.count_if(c == F.lit(v)) > 0, 0).otherwise(1) for v in self.value])
        if self.kind == "ratio_at_most":        # count_if(condition) / count(*) <= value
            ratio = F.try_divide(F.count_if(F.coalesce(self.condition, F.lit(False))),
                                 F.count(F.lit(1)))
            return F.when(ratio > F.lit(self.value), 1).otherwise(0)
        return None

    # ---- grouped rules: over one row per group, with its value (the number
    # of its rows, or their sum); ``own`` marks the groups of this rule's keys
    def of_rows(self) -> Column:
        """The value of a group, as an aggregate (or window function) of rows."""
        if self.kind in ("unique", "max_per_group"):
            return F.count(F.lit(1))
        if self.kind == "group_sum_near":
            return F.sum(self.column)
        raise ValueError(f"unknown rule kind {self.kind}")

    def of_groups(self, value: Column, own: Column) -> Column:
        if self.kind == "unique":
            return F.count_if(own & (value > 1))
        if self.kind == "max_per_group":
            # MAX over no rows is NULL and the CASE then fails: an empty window warns.
            return F.when(F.max(F.when(own, value)) <= F.lit(self.value), 0).otherwise(1)
        if self.kind == "group_sum_near":       # |sum(column) - target| <= tol per group
            target, tol = self.value
            return F.count_if(own & (F.abs(value - F.lit(target)) > F.lit(tol)))
        raise ValueError(f"unknown rule kind {self.kind}")


# ----------------------------------------------------------------- builders
def not_null(col, blocking=True):
    return Rule(f"{col}: not_null", "not_null", col, blocking=blocking)


def positive(col, blocking=True):
    return Rule(f"{col}: positive", "positive", col, blocking=blocking)


def non_negative(col, blocking=True):
    return Rule(f"{col}: non_negative", "non_negative", col, blocking=blocking)


def max_(col, value, blocking=True):
    return Rule(f"{col}: max {value}", "max", col, value, blocking=blocking)


def violations(name, condition: Column, blocking=True):
    return Rule(name, "violations", condition=condition, blocking=blocking)


def non_empty(name="not empty", blocking=True):
    return Rule(name, "non_empty", blocking=blocking)


def values_present(col, values, blocking=False):
    return Rule(f"{col}: all of {list(values)} present", "values_present", col, tuple(values),
                blocking=blocking)


def ratio_at_most(name, condition: Column, limit: float, blocking=False):
    return Rule(name, "ratio_at_most", value=limit, condition=condition, blocking=blocking)


def unique(*keys, blocking=True):
    return Rule(f"{', '.join(keys)}: unique", "unique", keys=tuple(keys), blocking=blocking)


def max_per_group(name, keys, limit, blocking=False):
    return Rule(name, "max_per_group", value=limit, keys=tuple(keys), blocking=blocking)


def group_sum_near(name, col, keys, target=1.0, tol=1e-4, blocking=True):
    return Rule(name, "group_sum_near", col, (target, tol), keys=tuple(keys), blocking=blocking)


# ------------------------------------------------------------------- report
def quality_report(df: DataFrame, rules, start=None, end=None, date_col: str = "date",
                   table: str | None = None) -> DataFrame:
    """One row per rule, in no particular order: (table, check, violations,
    passed, blocking).

    ``start``/``end`` restrict the checked rows to the run window on
    ``date_col`` (a partition predicate on a date-partitioned table).
    """
    if start is not None or end is not None:
        df = df.where(in_window(date_col, start, end))
    rules = list(rules)
    single = [r for r in rules if r.expr() is not None]
    grouped = [r for r in rules if r.expr() is None]
    parts = []
    if single:
        parts.append(_unpivoted(df.agg(*[r.expr().cast("long").alias(f"r{i}") for i, r in enumerate(single)]), single))
    if grouped:
        parts.append(_unpivoted(_over_groups(df, grouped), grouped))
    counts = reduce(DataFrame.unionByName, parts)
    violations_ = F.coalesce(F.col("violations"), F.lit(0).cast("long"))
    return counts.select(
        F.lit(table).cast("string").alias("table"), "check", violations_.alias("violations"),
        (violations_ == 0).alias("passed"), "blocking")


def _unpivoted(wide: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule from the one row that has the rules' counts."""
    rows = F.array(*[
        F.struct(F.lit(r.name).alias("check"), F.col(f"r{i}").alias("violations"), F.lit(r.blocking).alias("blocking"))
        for i, r in enumerate(rules)])
    return wide.select(F.inline(rows))


def _over_groups(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The counts of all grouped rules in one pass: the groups of every set of
    keys at once, then one row. With one set of keys that is a plain grouping."""
    sets = list(dict.fromkeys(r.keys for r in rules))
    columns = list(dict.fromkeys(k for keys in sets for k in keys))
    values = [r.of_rows().alias(f"v{i}") for i, r in enumerate(rules)]
    if len(sets) == 1:
        per, own = df.groupBy(*columns).agg(*values), [F.lit(True)] * len(rules)
    else:
        # a column that a set does not group by is marked, so that its NULL is
        # not taken for a group
        marks = [F.grouping(c).alias(f"g{k}") for k, c in enumerate(columns)]
        per = df.groupingSets([[F.col(c) for c in keys] for keys in sets], *columns).agg(*values, *marks)
        own = [reduce(Column.__and__, [F.col(f"g{k}") == int(c not in r.keys) for k, c in enumerate(columns)])
               for r in rules]
    return per.agg(*[r.of_groups(F.col(f"v{i}"), own[i]).cast("long").alias(f"r{i}") for i, r in enumerate(rules)])


def observe_rules(df: DataFrame, rules, table: str | None = None, given: dict | None = None):
    """Attach rules to ``df`` as observed metrics, so they are computed by
    whatever action later consumes ``df`` (e.g. the write that parses it)
    instead of by a second scan.

    A grouped rule needs on every row the value of the row's group, and one
    row that stands for the group. ``given`` has both for rules whose rows
    carry them already: ``{rule name: (value, once)}``; for the others they
    come from a window over the rule's keys, which is for small groups.

    Returns ``(observed_df, finish)``; after the action, ``finish()`` gives
    the report rows (same shape as ``quality_report``)."""
    from pyspark.sql import Observation

    rules, hidden, metrics = list(rules), {}, []
    for i, r in enumerate(rules):
        metric = r.expr()
        if metric is None:
            if r.name in (given or {}):
                value, once = given[r.name]
            else:
                group = Window.partitionBy(*r.keys)
                value = r.of_rows().over(group)
                once = F.row_number().over(group.orderBy(*r.keys)) == 1
            hidden |= {f"_value{i}": value, f"_once{i}": once}
            metric = r.of_groups(F.col(f"_value{i}"), F.col(f"_once{i}"))
        metrics.append(metric.cast("long").alias(f"r{i}"))
    obs = Observation(f"quality_{table or 'df'}")
    observed = (df.withColumns(hidden) if hidden else df).observe(obs, *metrics).drop(*hidden)

    def finish() -> list[dict]:
        got = {} if known_empty(observed) else _metrics(obs)
        if not got:          # a plan that turned out to have no rows may run without its metrics
            return [r.asDict() for r in quality_report(df, rules, table=table).collect()]
        rows = []
        for i, r in enumerate(rules):
            v = got.get(f"r{i}") or 0
            rows.append({"table": table, "check": r.name, "violations": int(v),
                         "passed": int(v) == 0, "blocking": r.blocking})
        return rows

    return observed, finish


def _metrics(obs) -> dict:
    """The observed values; none where the action did not run them (the JVM
    then has a row without columns, which cannot be converted)."""
    from py4j.protocol import Py4JJavaError
    try:
        return obs.get
    except Py4JJavaError as e:
        if "toPyRow" not in str(e):
            raise
        return {}


def known_empty(df: DataFrame) -> bool:
    """Whether the optimizer proved that the plan has no input rows."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return all(leaves.apply(i).getClass().getSimpleName() == "LocalRelation" and leaves.apply(i).data().isEmpty()
               for i in range(leaves.size()))


def gate(report) -> list[dict]:
    """Raise ``QualityError`` if a blocking rule failed; return all failures
    (warnings included) as dicts. ``report`` is a report DataFrame (only its
    failing rows are collected: one row per rule at most) or its rows."""
    if isinstance(report, DataFrame):
        failed = [r.asDict() for r in report.where(~F.col("passed")).collect()]
    else:
        failed = [dict(r) for r in report if not r["passed"]]
    blocking = [r for r in failed if r["blocking"]]
    if blocking:
        raise QualityError("; ".join(f"{r['table']}.{r['check']} ({r['violations']})"
                                     for r in blocking))
    return failed


def empty_dates(df: DataFrame, start, end, date_col: str = "date") -> DataFrame:
    """Dates of ``[start, end)`` without a single row (the per-date form of
    the non-empty check, which the source applies to the whole range only).
    The data side is reduced to its distinct dates before the anti join."""
    from ..sources.raw import date_slots
    present = df.where(in_window(date_col, start, end)).select(
        F.col(date_col).alias("date")).distinct()
    return date_slots(df.sparkSession, start, end).join(present, "date", "left_anti")


# ------------------------------------------------------- per-asset rule sets
def orderbook_rules():
    c = F.col
    return [
        non_empty("order book has rows"),
        violations("order book rows are complete and of a known type",
                   c("timestamp_received").isNull() | c("market_id").isNull()
                   | c("update_type").isNull() | c("data").isNull()
                   | ~c("update_type").isin(*S.UPDATE_TYPES)),
        values_present("update_type", S.UPDATE_TYPES, blocking=False),
    ]


def ticks_rules():
    c = F.col
    return [
        non_empty("ticks have rows"),
        violations("ticks are complete, in bounds and not inverted",
                   c("timestamp_received").isNull() | c("market_id").isNull()
                   | c("side").isNull() | ~c("side").isin(*S.SIDES)
                   | c("best_bid").isNull() | (c("best_bid") < 0.0) | (c("best_bid") > 1.0)
                   | c("best_ask").isNull() | (c("best_ask") < 0.0) | (c("best_ask") > 1.0)
                   | c("spread").isNull() | (c("best_ask") < c("best_bid"))),
    ]


def payload_rules(malformed_limit: float = 0.01):
    """Of landed payload read with its malformed lines (``payload.CORRUPT``)."""
    return [
        non_empty("payload has lines", blocking=False),
        ratio_at_most("malformed share within its limit", F.col(CORRUPT).isNotNull(), malformed_limit, blocking=False),
        violations("lines are well-formed", F.col(CORRUPT).isNotNull(), blocking=False),
    ]


def dim_rules(ghost_ratio_limit: float = 0.10):
    return [
        non_empty("dimension has rows"),
        ratio_at_most("ghost share within its limit",
                      F.col("is_ghost") == F.lit(True), ghost_ratio_limit, blocking=False),
        violations("dimension rows have an id", F.col("market_id").isNull()),
    ]


def view_rules():
    return [
        not_null("market_id"),
        violations("view ids are not blank", F.trim(F.col("market_id")) == F.lit("")),
        unique("market_id"),
    ]


def activity_rules():
    return [
        not_null("date"), not_null("category"), positive("market_count"),
        positive("tick_count"), non_negative("avg_spread"), max_("avg_spread", 1.0),
        non_empty("fact has rows"),
    ]


def history_rules():
    return [
        not_null("market_id"), positive("tick_count"), non_negative("avg_spread"),
        max_("avg_spread", 1.0), non_empty("fact has rows"),
    ]


def over_time_rules():
    return [
        not_null("date"), not_null("hour"), not_null("avg_spread"), non_negative("avg_spread"),
        max_("avg_spread", 1.0), not_null("tick_count"), positive("tick_count"),
        non_empty("fact has rows"),
    ]


def distribution_rules():
    return [
        not_null("date"), not_null("spread_tier"), positive("tick_count"),
        non_empty("fact has rows"),
        max_per_group("at most 3 tiers a day", ["date"], 3),
    ]


def expiry_rules():
    c = F.col
    labels = [b[0] for b in S.EXPIRY_BUCKETS]
    mismatch = ~c("expiry_bucket").isin(*labels)
    for label, order, _lo, _hi in S.EXPIRY_BUCKETS:
        mismatch = mismatch | ((c("expiry_bucket") == label) & (c("expiry_bucket_order") != order))
    return [
        not_null("date"), not_null("expiry_bucket"), not_null("expiry_bucket_order"),
        positive("expiry_bucket_order"), max_("expiry_bucket_order", 5),
        positive("market_count"), positive("total_tick_count"),
        non_negative("avg_market_tick_count"), non_negative("avg_spread"),
        max_("avg_spread", 1), non_negative("avg_spread_volatility"),
        non_empty("fact has rows"),
        violations("bucket and order agree", mismatch),
        max_per_group("at most 5 buckets a day", ["date"], 5),
    ]


SHARE_SUM_CHECK = "shares of a category-day add up to 1"


def concentration_rules(hhi_tolerance: float = 1e-4, share_max: float = 1.0):
    """``share_max`` is the bound of the per-column ``max`` checks (exact 1 in
    the source, while its own HHI check allows 1.0001)."""
    c = F.col
    rules = [not_null("date"), not_null("category"), not_null("market_id"),
             positive("market_tick_count"), positive("category_tick_count"),
             positive("active_markets"), positive("market_rank_in_category")]
    for col in ("market_tick_share", "avg_spread", "top_market_share", "top_3_market_share",
                "hhi_concentration_index"):
        rules += [non_negative(col), max_(col, share_max)]
    rules += [
        non_negative("spread_volatility"),
        non_empty("fact has rows"),
        group_sum_near(SHARE_SUM_CHECK,
                       "market_tick_share", ["date", "category"], 1.0, 1e-4),
        violations("Herfindahl index within 0 and 1",
                   (c("hhi_concentration_index") < 0)
                   | (c("hhi_concentration_index") > 1 + hhi_tolerance), blocking=False),
    ]
    return rules
