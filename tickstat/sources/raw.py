"""Landed order-book files: scan, slot calendar, inventory and integrity.

Hourly files land as ``<root>/date=YYYY-MM-DD/YYYY-MM-DDTHH.parquet``. The
scan is a partitioned Parquet read with a declared schema (partition pruning
on ``date``, column pruning to what the plan uses). The slot calendar,
completeness summary and integrity audit are Spark jobs over file listings,
not driver loops over files.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.columns import _as_date, in_window

_SLOT_RE = r"(\d{4}-\d{2}-\d{2}T\d{2})(?:\.parquet$|/[^/]*$)"      # a file, or files in a folder, of that name
_DATE_DIR_RE = r"date=(\d{4}-\d{2}-\d{2})"


LEDGER = "_ledger"                   # of a table that the ingest fills


def reload_state(spark: SparkSession, root: str) -> tuple[set[str], dict[str, str]]:
    """Reloads under way in a table: names (``<load>.<landing folder>``), and
    of those that are committed the last batch that they replace."""
    from ..operators import sinks as SK
    marks = f"{root.rstrip('/')}/{LEDGER}"
    commits = dict(name.rsplit(".", 1) for name in SK._list_files(spark, f"{marks}/reloads"))
    return set(SK._list_files(spark, f"{marks}/pending")), commits


def live_rows(pending: set[str], commits: dict[str, str]) -> Column:
    """Rows that count while reloads are under way: of a committed one its own
    and not those it replaces, of another one not its own."""
    load, src, live = F.col("load"), F.col("src"), F.lit(True)
    for name in sorted(pending):
        reload_id, folder = name.split(".")
        if name in commits:
            older = F.when(load.startswith("b"), load <= commits[name]).otherwise(load < reload_id)
            live = live & ~((src == F.lit(folder).cast("date")) & older)
        else:
            live = live & ~((src == F.lit(folder).cast("date")) & (load == reload_id))
    return live


def scan_raw(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """Raw order book of ``[start, end)`` from a ``date=``-partitioned folder.

    The window lands in ``PartitionFilters``: folders outside it are never
    listed for reading. In a table that the ingest fills (a folder per landing
    folder and load inside each date), a reload under way is seen as a whole
    or not at all; the files are listed again if one began or ended meanwhile."""
    schema = T.StructType(S.RAW_ORDERBOOK.fields + [T.StructField("date", T.DateType())])
    while True:
        state = reload_state(spark, root)
        df = spark.read.schema(schema).option("basePath", root).parquet(root)
        if state == reload_state(spark, root):
            break
    if state[0]:
        df = df.where(live_rows(*state))
    return df.where(in_window("date", start, end)).select(*schema.fieldNames())


def partition_row_counts(orderbook: DataFrame, start=None, end=None) -> DataFrame:
    """Rows present per date (DATE of ``timestamp_received``)."""
    from ..operators.ticks import window_rows
    day = F.to_date("timestamp_received")
    return window_rows(orderbook, start, end).groupBy(day.alias("date")).agg(F.count(F.lit(1)).alias("row_count"))


# ------------------------------------------------------------ slot calendar
def _slots(bounds: DataFrame, start: Column, end: Column, step: str, fmt: str | None,
           name: str) -> DataFrame:
    # sequence() raises on an empty range (start = end): guard with CASE,
    # which only evaluates the branch it takes.
    seq = F.when(start < end, F.sequence(start, end - F.expr(f"INTERVAL 1 {step}"),
                                         F.expr(f"INTERVAL 1 {step}")))
    out = bounds.select(F.explode(F.coalesce(seq, F.array())).alias("slot_start"))
    if fmt:
        out = out.select(F.date_format("slot_start", fmt).alias(name), "slot_start")
    return out


def hour_slots_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end"
                       ) -> DataFrame:
    """Hourly slots of each ``[start, end)`` row of ``bounds`` (dates or
    timestamps), labelled ``YYYY-MM-DDTHH``."""
    start = F.col(start_col).cast("timestamp")
    end = F.col(end_col).cast("timestamp")
    return _slots(bounds, start, end, "HOUR", S.HOUR_SLOT_FORMAT, "slot")


def hour_slots(spark: SparkSession, start, end) -> DataFrame:
    """Expected hourly slots of ``[start, end)``; empty when start = end."""
    bounds = spark.range(1).select(F.lit(_as_date(start)).alias("start"),
                                   F.lit(_as_date(end)).alias("end"))
    return hour_slots_between(bounds)


def date_slots(spark: SparkSession, start, end) -> DataFrame:
    """Dates of ``[start, end)`` as a one-column DataFrame ``date``."""
    s, e = F.lit(_as_date(start)), F.lit(_as_date(end))
    seq = F.when(s < e, F.sequence(s, F.date_sub(e, 1)))
    return spark.range(1).select(F.explode(F.coalesce(seq, F.array())).alias("date"))


def date_slots_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Dates of each ``[start, end)`` row of ``bounds``."""
    s, e = F.col(start_col).cast("date"), F.col(end_col).cast("date")
    seq = F.when(s < e, F.sequence(s, F.date_sub(e, 1)))
    return bounds.select(F.explode(F.coalesce(seq, F.array())).alias("date"))


def data_hour_bounds(df: DataFrame, ts_col: str = "timestamp_received") -> DataFrame:
    """One row ``[first date, last date + 1)`` covering the data (a global
    aggregate: one partial row per task)."""
    day = F.to_date(ts_col)
    return df.agg(F.min(day).alias("start"), F.date_add(F.max(day), 1).alias("end"))


def landed_slots_from_paths(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Slot label parsed from landed file paths (``...THH.parquet``)."""
    return paths.select(F.regexp_extract(path_col, _SLOT_RE, 1).alias("slot")) \
        .where(F.col("slot") != "").distinct()


def landed_files(df: DataFrame) -> DataFrame:
    """``(path, modified)`` of the files behind a scan that have rows, from the
    scan's own metadata columns: no data column is read."""
    return df.select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_modification_time").alias("modified")).distinct()


def landed_slots_from_data(df: DataFrame, ts_col: str = "timestamp_received") -> DataFrame:
    """Hours that have at least one row (partial aggregation per task)."""
    return df.select(F.date_format(ts_col, S.HOUR_SLOT_FORMAT).alias("slot")).distinct()


def missing_slots(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected slots with nothing landed (the skip-if-exists test)."""
    return expected.join(landed.select("slot"), "slot", "left_anti")


def slot_status(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """(slot, ok) for every expected slot."""
    got = landed.select("slot").distinct().withColumn("ok", F.lit(True))
    return expected.select("slot").join(got, "slot", "left") \
        .select("slot", F.coalesce("ok", F.lit(False)).alias("ok"))


def completeness(status: DataFrame, key: str = "slot") -> DataFrame:
    """One row: total, succeeded, failed and the sorted failed keys. The list
    is bounded by the number of slots in the run window."""
    return status.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("ok")).alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col(key)))).alias("failed_keys"),
    )


def completeness_gate(summary: DataFrame) -> dict:
    """Raise if any slot failed; return the (one-row) summary."""
    row = summary.first().asDict()
    if row["failed"]:
        raise RuntimeError(f"{row['failed']} of {row['total']} slots failed: {row['failed_keys']}")
    return row


# ---------------------------------------------------------- files on disk
def file_inventory(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Every file under ``root`` with its size and ``date=`` folder. Only
    path and length are selected, so file contents are never read."""
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true")
             .load(root)
             .select("path", "length"))
    date_text = F.regexp_extract("path", _DATE_DIR_RE, 1)
    return files.select(
        F.when(date_text != "", date_text).cast("date").alias("date"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        "path",
        F.col("length").alias("size_bytes"),
    )


_INTEGRITY_SCHEMA = "path string, size_bytes long, head string, tail string, ok boolean, error string"
_MAGIC = S.PARQUET_MAGIC

# Ship this module's code with the mapInPandas function (pickled by value):
# Python workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _check_magic(batches):
    import pyarrow.fs as pafs

    for pdf in batches:
        heads, tails, oks, errors = [], [], [], []
        for path, size in zip(pdf["path"], pdf["size_bytes"]):
            head, tail, error = None, None, None
            try:
                fs, p = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(p) as f:
                    n = f.size()
                    head = f.read_at(4, 0) if n >= 4 else f.read_at(n, 0)
                    tail = f.read_at(4, n - 4) if n >= 4 else b""
            except (OSError, ValueError) as e:       # not read: says nothing about the file
                error = f"{type(e).__name__}: {e}"
            heads.append(None if error else head.hex())
            tails.append(None if error else tail.hex())
            oks.append(None if error else head == _MAGIC and tail == _MAGIC)
            errors.append(error)
        yield pd.DataFrame({"path": pdf["path"], "size_bytes": pdf["size_bytes"], "head": heads,
                            "tail": tails, "ok": pd.array(oks, "boolean"), "error": errors})


def parquet_integrity(files: DataFrame) -> DataFrame:
    """(path, size_bytes, head, tail, ok, error): a file is sound when its
    first and last four bytes are the Parquet magic ``PAR1``. A file that could
    not be read (rights, network, unknown scheme) has a NULL ``ok`` and the
    reason in ``error``.

    Runs on the executors over the listing from ``file_inventory``: each task
    reads 8 bytes per file, so auditing millions of files is a wide, cheap
    job. Returns the report; removing bad files is left to the caller."""
    return files.select("path", "size_bytes").mapInPandas(_check_magic, _INTEGRITY_SCHEMA)
