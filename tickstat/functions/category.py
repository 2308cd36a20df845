"""Category of a market from its tags (built-in array functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S


def _canonical() -> Column:
    return F.array(*[
        F.struct(F.lit(i).alias("id"), F.lit(label).alias("label"), F.lit(slug).alias("slug"))
        for i, label, slug in S.CANONICAL_TAGS])


def pick_category(tags: Column, first_wins: bool = False) -> Column:
    """struct(category, category_slug) for an array<struct<id, label>>.

    Canonical tags are scanned in priority order and, as in the source, the
    LAST listed match wins (``first_wins=True`` gives the documented
    first-match behaviour). Without a canonical tag the first tag whose label
    is non-empty and does not mention "rewards" is used, slug = lower case
    with spaces as hyphens; otherwise Unknown / unknown.
    """
    ids = F.transform(tags, lambda t: t["id"].cast("string"))
    matches = F.filter(_canonical(), lambda c: F.array_contains(ids, c["id"]))
    chosen = F.try_element_at(matches, F.lit(1 if first_wins else -1))
    usable = F.filter(tags, lambda t: t["label"].isNotNull() & (t["label"] != "")
                      & ~F.lower(t["label"]).contains(S.REWARDS_WORD))
    fallback = F.try_element_at(usable, F.lit(1))["label"]
    category = F.coalesce(chosen["label"], fallback, F.lit(S.ENRICH_UNKNOWN))
    slug = F.coalesce(chosen["slug"], F.replace(F.lower(fallback), F.lit(" "), F.lit("-")),
                      F.lit(S.ENRICH_UNKNOWN_SLUG))
    return F.struct(category.alias("category"), slug.alias("category_slug"))
