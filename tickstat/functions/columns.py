"""Column expressions shared by the operators.

All of them are built-in Spark expressions (JVM side, inside whole-stage
codegen); none needs Python at run time.
"""

from __future__ import annotations

from datetime import date as _date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# a decimal number with optional exponent, or one of the special values; Spark's
# own cast also takes type suffixes ("0.5d"), which are junk in a price
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf(inity)?)\s*$"
_DATED = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def to_double(text: str | Column, strict: bool = False) -> Column:
    """Text to float64. ``strict`` is a hard cast (raises on garbage under
    ANSI, like the source's CAST); the default gives NULL instead so the row is
    rejected by the guards and counted in the reject report. Text that is not
    written as a number is garbage in both."""
    c = col_(text)
    if strict:
        bad = F.raise_error(F.concat(F.lit("not a number: "), c)).cast("double")
        return F.when(c.isNull() | c.rlike(_NUMBER), c.cast("double")).otherwise(bad)
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def to_timestamp(text: str | Column) -> Column:
    """Text to timestamp, NULL for junk. A time without a date is junk: a cast
    would put today's date in front of it."""
    c = col_(text)
    return F.when(c.rlike(_DATED), c.try_cast("timestamp"))


# The ways a date is written, tried in this order: what the date part looks
# like, and the format that reads it. 03/14/2026 has the month in front unless
# that makes no date.
_WEEKDAY = r"^\s*(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,?\s+)?"
_TAIL = (r"(?:(?:[T,]\s*|\s+)(?:at\s+)?\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?:\s*[ap]\.?m\.?)?)?"
         r"\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})?\s*$")
DATE_LADDER = (
    (r"(\d{4}-\d{1,2}-\d{1,2})", "yyyy-M-d"),
    (r"(\d{4}/\d{1,2}/\d{1,2})", "yyyy/M/d"),
    (r"(\d{4}\.\d{1,2}\.\d{1,2})", "yyyy.M.d"),
    (r"(\d{8})", "yyyyMMdd"),
    (r"(\d{1,2}/\d{1,2}/\d{4})", "M/d/yyyy"),
    (r"(\d{1,2}/\d{1,2}/\d{4})", "d/M/yyyy"),
    (r"(\d{1,2}-\d{1,2}-\d{4})", "M-d-yyyy"),
    (r"(\d{1,2}-\d{1,2}-\d{4})", "d-M-yyyy"),
    (r"([a-z]{3,9}\.?\s+\d{1,2}(?:st|nd|rd|th)?,?\s+\d{4})", "MMM d yyyy"),
    (r"(\d{1,2}(?:st|nd|rd|th)?[\s-]+[a-z]{3,9}\.?,?[\s-]+\d{4})", "d MMM yyyy"),
)


def written_date(text: str | Column) -> Column:
    """The calendar date that a text states, NULL if it states none. A time
    and a zone may follow; they do not move the date. Each row is read by
    itself, by the first way of writing that fits it and gives a date."""
    c = col_(text)
    out = []
    for shape, fmt in DATE_LADDER:
        pattern = f"(?i){_WEEKDAY}{shape}{_TAIL}"
        found = F.regexp_extract(c, pattern, 1)
        if "MMM" in fmt:                     # Mar, March, MARCH, Sept.: three letters tell a month
            found = F.regexp_replace(F.regexp_replace(found, r"(?i)(\d)(st|nd|rd|th)", "$1"), r"[\s,.-]+", " ")
            found = F.initcap(F.regexp_replace(found, r"(?i)([a-z]{3})[a-z]*", "$1"))
        out.append(F.when(c.rlike(pattern), F.try_to_date(found, fmt)))
    return F.coalesce(*out)


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """NULL instead of a division-by-zero error."""
    return F.try_divide(col_(num), col_(den))


def guarded_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation that is NULL (not an error) for fewer than two
    points or zero variance.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI on a constant input, and a CASE
    around the aggregate does not help because the aggregate is evaluated
    first. covar_pop / (stddev_pop * stddev_pop) with a guarded division is
    the same statistic. x and y must be NULL on the same rows.
    """
    x, y = col_(x), col_(y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def in_window(date_col: str | Column, start=None, end=None) -> Column:
    """Half-open ``[start, end)`` date predicate; an open side is no bound."""
    c = col_(date_col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(_as_date(start)))
    if end is not None:
        cond = cond & (c < F.lit(_as_date(end)))
    return cond


def _as_date(value) -> _date:
    if isinstance(value, _date):
        return value
    return _date.fromisoformat(str(value)[:10])


def spread_tier(spread: str | Column) -> Column:
    """Tier label; first matching upper bound wins, thresholds inclusive."""
    s = col_(spread)
    expr = None
    for bound, label in S.TIER_BOUNDS:
        expr = F.when(s <= bound, label) if expr is None else expr.when(s <= bound, label)
    return expr.otherwise(S.TIER_WIDE)


def days_to_expiry(end_ts: str | Column, day: str | Column) -> Column:
    """Whole days from the trading date to the market's end date."""
    return F.datediff(F.to_date(col_(end_ts)), col_(day))


def _bucketed(days: Column, pick) -> Column:
    expr = None
    default = None
    for label, order, lo, hi in S.EXPIRY_BUCKETS:
        value = pick(label, order)
        if lo is None:
            cond = days <= hi
        elif hi is None:
            default = value
            continue
        else:
            cond = days.between(lo, hi)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default)


def expiry_bucket(days: str | Column) -> Column:
    return _bucketed(col_(days), lambda label, order: F.lit(label))


def expiry_bucket_order(days: str | Column) -> Column:
    return _bucketed(col_(days), lambda label, order: F.lit(order))


def yes_only(value: str | Column, side: str | Column = "side") -> Column:
    """Value on YES-side rows, NULL elsewhere (conditional aggregation)."""
    return F.when(col_(side) == "YES", col_(value))


def json_scalar(value: str | Column, data: str | Column, key: str) -> Column:
    """Scalar-only reading of one ``json_tuple`` field.

    ``json_tuple`` returns an object or array value as its JSON text, where a
    scalar-only extraction gives NULL. Only values whose text starts with
    ``{`` or ``[`` can be either; for those rows alone (a CASE branch) the
    payload is parsed with types, which tells a nested value (-> NULL) from a
    string that merely starts with a bracket.
    """
    v, d = col_(value), col_(data)
    typed = F.schema_of_variant(F.try_variant_get(F.try_parse_json(d), f"$.{key}", "variant"))
    maybe_nested = v.startswith("{") | v.startswith("[")
    return F.when(maybe_nested, F.when(typed == "STRING", v)).otherwise(v)
