"""Market dimension: the cleansed view, discovery of new ids and enrichment.

The dimension is small (one row per market ever seen) and every operator here
is a join or a projection over it; nothing is collected to the driver. The
source's HTTP client, thread pool and batching are replaced by reading the
landed metadata as a DataFrame (``sources.payload``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import to_timestamp, written_date


def markets_view(dim: DataFrame) -> DataFrame:
    """Ghosts removed (NULL ``is_ghost`` is removed too), category defaults
    applied, ``end_date`` text safely cast to a timestamp (junk -> NULL)."""
    return dim.where(F.col("is_ghost") == F.lit(False)).select(
        F.col("market_id").cast("string").alias("market_id"),
        "question",
        "event_title",
        F.coalesce("category", F.lit(S.VIEW_UNKNOWN_CATEGORY)).alias("category"),
        F.coalesce("category_slug", F.lit(S.VIEW_UNKNOWN_SLUG)).alias("category_slug"),
        to_timestamp("end_date").alias("end_date"),
        "closed",
        "resolution_status",
    )


def new_market_ids(orderbook: DataFrame, dim: DataFrame, start=None, end=None,
                   retry_ghosts: bool = False) -> DataFrame:
    """Distinct order-book market ids that the dimension does not hold yet.

    Both sides are reduced to distinct ids first (partial aggregation), so the
    anti join compares id sets, not ticks. With a window only its dates are
    scanned (the source scans the whole table). Ghost rows count as held, as
    in the source (a ghost is never fetched again); ``retry_ghosts=True``
    requests them again (see ``resolve_ghosts``)."""
    from .ticks import window_rows
    ids = window_rows(orderbook, start, end).where(F.col("market_id").isNotNull()) \
        .select(F.col("market_id").cast("string").alias("market_id")).distinct()
    held = dim.where(F.col("is_ghost") == F.lit(False)) if retry_ghosts else dim
    return ids.join(held.select("market_id"), "market_id", "left_anti")


def resolve_ghosts(dim: DataFrame, enriched: DataFrame) -> DataFrame:
    """The dimension with ghost rows replaced by enriched, non-ghost rows of
    the same id (every other row untouched). Used with
    ``new_market_ids(retry_ghosts=True)``; ids still unresolved stay ghosts."""
    resolved = enriched.where(F.col("is_ghost") == F.lit(False))
    ghosts_fixed = dim.where(F.col("is_ghost") == F.lit(True)) \
        .join(resolved.select("market_id"), "market_id", "left_semi")
    kept = dim.join(ghosts_fixed.select("market_id"), "market_id", "left_anti")
    return kept.unionByName(resolved.join(ghosts_fixed.select("market_id"), "market_id", "left_semi")
                            .select(*dim.columns))


def enrich_markets(ids: DataFrame, payload: DataFrame, event_tags: DataFrame,
                   first_wins: bool = False) -> DataFrame:
    """Dimension rows (``schemas.DIM_MARKETS``) for the requested ``ids``.

    ``payload`` holds the landed market metadata (``schemas.MARKET_PAYLOAD``),
    ``event_tags`` the tags per event id (``schemas.EVENT_TAGS``). Requested
    ids without metadata become ghost rows. An event with an id takes its tags
    from ``event_tags`` only (none when that lookup has no row); the payload's
    own tags are used only for events without an id.
    """
    from ..functions.category import pick_category
    from ..functions.text import sanitize_text

    # only what was asked for is looked up and cleaned, however much has landed
    requested = ids.select(F.col("market_id").cast("string").alias("market_id")).distinct()
    p = payload.where(F.col("conditionId").isNotNull() & (F.col("conditionId") != "")) \
        .withColumn("market_id", F.col("conditionId").cast("string")) \
        .join(requested, "market_id", "left_semi")
    event = F.try_element_at(F.col("events"), F.lit(1))
    p = p.select("*", event.alias("_event"))
    # one answer per event: a repeated lookup must not multiply its markets
    tags = event_tags.groupBy(F.col("event_id").alias("_event_id")).agg(F.min("tags").alias("_tags"))
    p = p.join(tags, F.col("_event.id") == F.col("_event_id"), "left")
    has_event_id = F.col("_event.id").isNotNull() & (F.col("_event.id") != "")
    market_tags = F.when(has_event_id, F.coalesce("_tags", F.array())) \
        .otherwise(F.coalesce(F.col("_event.tags"), F.array()))
    picked = pick_category(market_tags, first_wins)
    status = _resolution_status(F.col("umaResolutionStatus"), F.col("umaResolutionStatuses"))
    found = p.select(
        "market_id",
        _text_or_unknown(sanitize_text(F.col("question"))).alias("question"),
        _text_or_unknown(sanitize_text(F.col("_event.title"))).alias("event_title"),
        picked["category"].alias("category"),
        picked["category_slug"].alias("category_slug"),
        _end_date_text(F.col("endDateIso"), F.col("endDate")).alias("end_date"),
        F.coalesce(F.col("closed"), F.lit(False)).alias("closed"),
        status.alias("resolution_status"),
        F.lit(False).alias("is_ghost"),
    )
    j = requested.join(found, "market_id", "left")
    ghost = F.col("is_ghost").isNull()
    return j.select(
        "market_id",
        F.when(ghost, F.lit(S.GHOST_QUESTION)).otherwise(F.col("question")).alias("question"),
        F.when(ghost, F.lit(S.ENRICH_UNKNOWN)).otherwise(F.col("event_title")).alias("event_title"),
        F.when(ghost, F.lit(S.ENRICH_UNKNOWN)).otherwise(F.col("category")).alias("category"),
        F.when(ghost, F.lit(S.ENRICH_UNKNOWN_SLUG)).otherwise(F.col("category_slug"))
         .alias("category_slug"),
        "end_date",
        "closed",
        "resolution_status",
        F.coalesce(F.col("is_ghost"), F.lit(True)).alias("is_ghost"),
    )


def _text_or_unknown(c):
    """``text or 'Unknown'``: NULL and empty both default."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(S.ENRICH_UNKNOWN))


def _first_truthy(*cols):
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def _end_date_text(iso, other):
    """First non-empty of the two end-date fields, parsed per row to
    ``YYYY-MM-DD`` (NULL when unparseable): the date as it is written
    (``columns.written_date``), else what a timestamp cast makes of it."""
    raw = F.trim(_first_truthy(iso, other))
    return F.date_format(F.coalesce(written_date(raw), F.to_date(to_timestamp(raw))), "yyyy-MM-dd")


def end_date_report(payload: DataFrame) -> DataFrame:
    """One row: markets, those with an end date in text, those whose text is
    read as a date, and those whose is not."""
    text = F.trim(_first_truthy(F.col("endDateIso"), F.col("endDate")))
    parsed = _end_date_text(F.col("endDateIso"), F.col("endDate")).isNotNull()
    return payload.agg(F.count(F.lit(1)).alias("markets"), F.count_if(text.isNotNull()).alias("with_text"),
                       F.count_if(parsed).alias("parsed"), F.count_if(text.isNotNull() & ~parsed).alias("unparsed"))


def _resolution_status(single, many):
    """The single status if it has text; else the other field (a variant): a
    list gives its first element, text is taken as it is; '', '[]' and an
    empty list give NULL."""
    kind = F.schema_of_variant(many)
    text = F.when(kind == "STRING", F.try_variant_get(many, "$", "string"))
    first = F.when(kind.startswith("ARRAY"), F.try_variant_get(many, "$[0]", "string"))
    raw = F.coalesce(_first_truthy(single, text), first)
    return F.when(F.trim(raw) != "[]", raw)
