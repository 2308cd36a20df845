"""Secret scan with corpus-wide ownership frequency, all in SQL functions.

Candidates are found in every whole text by pattern. Their values are hashed
and counted over the corpus by distinct owners and distinct repositories: a
value that many owners or many repositories have is a copied example (also when
all the copies are of one hot owner), one that a single owner has in few
repositories and that looks random is a live-looking credential, whose value is reported as
a span of kind ``live``.

Positions: splitting a text at a pattern gives the gaps between its matches,
so a match starts at the sum of the gaps and matches before it. The sums are
taken over the exploded matches (a window per document and kind), which stays
linear in a text with very many of them. Values never leave the scan as plain
text: what is written between the steps holds their digest and shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_once

# fixed values: the patterns looked for; kinds in the order of the result
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"         # a run of 32 or more, as the run is greedy
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "live")
COPIED = 3                     # owners that make a value a copied example
COPIED_REPOSITORIES = 10       # repositories that do, whoever owns them
LIVE_CHARS, LIVE_DISTINCT = 16, 8


def _matches(pattern: str, kind: str, value_group: int) -> Column:
    """``array<struct<kind, gap, length, value...>>`` of a text's matches in order."""
    text, group = F.col("text"), F.lit(0)
    found = F.regexp_extract_all(text, F.lit(pattern), group)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("match"), values.alias("value"))
    shape = F.transform(
        F.filter(rows, lambda x: x["match"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"),
            F.char_length(x["gap"]).alias("gap"), F.char_length(x["match"]).alias("length"),
            F.char_length(x["value"]).alias("value_length"), F.md5(x["value"]).alias("value"),
            (x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]")
             & (F.size(F.array_distinct(F.regexp_extract_all(x["value"], F.lit("."), group))) >= LIVE_DISTINCT))
            .alias("random")))
    return F.when(text.rlike(pattern), shape)


def candidates(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """``(row, doc_id, owner, repository, found)`` of every row, written once
    (so ``row`` numbers are fixed); ``found`` lists all matches, NULL without any."""
    src = docs.select("doc_id", F.col(owner).cast("string").alias("owner"),
                      F.col(repository).cast("string").alias("repository"), "text")
    lists = [_matches(ASSIGN, "assign", 2), _matches(ACCESS, "access", 0), _matches(HEX, "hex", 0)]
    # one projection per list: the patterns run once each
    for k, column in enumerate(lists):
        src = src.withColumn(f"_{k}", column)
    some = F.coalesce("_0", "_1", "_2")
    none = F.slice(some, 1, 0)
    found = F.concat(*(F.coalesce(F.col(f"_{k}"), none) for k in range(3)))
    return write_once(src.select("doc_id", "owner", "repository", found.alias("found"))
                      .withColumn("row", F.monotonically_increasing_id()), "secrets")


def ownership(spans: DataFrame) -> DataFrame:
    """``(value, owners, repositories)``: distinct owners and repositories of
    every value. Pairs are made distinct first, with map-side combining, so a
    value in a third of all rows arrives as its distinct pairs, already spread."""
    value, both = "value", []
    for name in ("owner", "repository"):
        each = spans.select(value, F.coalesce(name, F.lit("")).alias(name)).distinct()
        both.append(each.groupBy(value).agg(F.count("*").alias("n")))
    return (both[0].withColumnRenamed("n", "owners")
            .join(both[1].withColumnRenamed("n", "repositories"), value))


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", copied: int = COPIED,
         copied_repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """``(doc_id, spans array<struct<start, kind, stop, owners, repositories,
    label>>)`` for every row, in order of start and kind; the array is empty
    without any. ``label``: ``example`` (``copied`` or more owners, or
    ``copied_repositories`` or more repositories), ``live`` (otherwise, one
    owner, looks random), else ``shared``; a live value is also a span of
    kind ``live`` of its own. NULL owners count as one owner. Repeated rows are
    separate rows of one repository."""
    rows = candidates(docs, owner, repository)
    order = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    least = F.array(*(F.lit(LEAST[k]) for k in KINDS[:3]))
    spans = (rows.select("row", "owner", "repository", F.inline("found"))
             .withColumn("stop", F.sum(F.col("gap") + F.col("length")).over(order))
             .withColumn("start", F.col("stop") - F.col("length"))
             .where(F.col("value_length") >= F.get(least, F.col("kind"))))
    label = (F.when((F.col("owners") >= copied) | (F.col("repositories") >= copied_repositories), "example")
             .when((F.col("owners") == 1) & F.col("random") & (F.col("value_length") >= LIVE_CHARS), "live")
             .otherwise("shared"))
    named = spans.join(ownership(spans), "value", "left").withColumn("label", label)
    base = F.struct("start", "kind", "stop", "owners", "repositories", "label")
    live = F.struct((F.col("stop") - F.col("value_length")).alias("start"),
                    F.lit(KINDS.index("live")).alias("kind"), "stop", "owners", "repositories", "label")
    each = F.when(F.col("label") == "live", F.array(base, live)).otherwise(F.array(base))
    listed = named.groupBy("row").agg(F.sort_array(F.flatten(F.collect_list(each))).alias("spans"))
    return (rows.select("row", "doc_id").join(listed, "row", "left")
            .select("doc_id", F.coalesce("spans", F.array().cast(listed.schema["spans"].dataType)).alias("spans")))


def span_string(spans: Column) -> Column:
    """``kind:start:stop`` of the spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
