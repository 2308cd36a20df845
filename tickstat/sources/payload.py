"""Landed market metadata: the API responses stored as JSON lines.

Markets (``schemas.MARKET_PAYLOAD``: conditionId, question, events[] with
tags[], end dates, closed, resolution statuses) and tags per event
(``schemas.EVENT_TAGS``) are read with declared schemas - never inferred - so
a missing field is NULL and the string-or-list field ``umaResolutionStatuses``
is a variant, whose type ``operators.markets.enrich_markets`` tests.

A line that is no JSON object of that form would give a row of NULLs and be
dropped unseen, and its market would stay a ghost for good. Reading keeps such
a line, whole, in the column ``CORRUPT``; ``split_payload`` parts the good rows
from this quarantine, and ``quality.payload_rules`` checks its share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

CORRUPT = "_corrupt_record"


def _parsed(lines: DataFrame, column: str, schema: T.StructType, *kept) -> DataFrame:
    """Objects from a column of JSON text; blank lines are no rows."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col(column)
    row = F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # text that is JSON but no object parses to nothing without being marked
    bad = F.coalesce(F.col(f"_p.{CORRUPT}"), F.when(~text.rlike(r"^\s*\{"), text))
    return (lines.where(F.trim(text) != "").select(row.alias("_p"), text, *kept)
            .select(*(F.col(f"_p.{f.name}") for f in schema.fields), bad.alias(CORRUPT), *kept))


def read_market_payload(spark: SparkSession, path: str, quarantine: bool = False) -> DataFrame:
    """Landed market objects, one JSON object per line. ``quarantine`` adds
    ``CORRUPT``, the text of a malformed line (whose other columns do not
    count), and ``file``, where the line is from; without it malformed lines
    are left out."""
    lines = spark.read.text(path)
    if quarantine:
        return _parsed(lines, "value", S.MARKET_PAYLOAD, F.col("_metadata.file_path").alias("file"))
    return split_payload(_parsed(lines, "value", S.MARKET_PAYLOAD))[0]


def parse_market_payload(lines: DataFrame, column: str = "value", quarantine: bool = False) -> DataFrame:
    """Market objects from a column of JSON text (one object per row), with
    ``CORRUPT`` where ``quarantine`` is asked for."""
    parsed = _parsed(lines, column, S.MARKET_PAYLOAD)
    return parsed if quarantine else split_payload(parsed)[0]


def split_payload(payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the quarantine: the malformed lines, with their file
    where it is known."""
    bad = F.col(CORRUPT).isNotNull()
    kept = [c for c in ("file",) if c in payload.columns]
    return payload.where(~bad).drop(CORRUPT, *kept), payload.where(bad).select(F.col(CORRUPT).alias("line"), *kept)


def read_event_tags(spark: SparkSession, path: str) -> DataFrame:
    """Tags per event id, one ``{"event_id": ..., "tags": [...]}`` per line."""
    return spark.read.schema(S.EVENT_TAGS).option("mode", "PERMISSIVE").json(path)
