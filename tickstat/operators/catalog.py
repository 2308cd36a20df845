"""Atomic replacement of date partitions in catalog tables.

A partition of an external catalog table is a pointer to a folder. Fresh rows
are written once, to a folder of a version of their own
(``<table>/_versions/<id>/date=YYYY-MM-DD``); then every date of the window is
pointed at it, one metadata call a date: ``SET LOCATION`` where the date is
there, ``ADD PARTITION`` where it is not, ``DROP PARTITION`` (which leaves an
external table's files) where it has no fresh rows. Nothing is moved or
rewritten, so it costs the same on an object store, and a reader sees a date
whole, old or new, wherever a run stops; running it again finishes it.
``vacuum`` deletes the folders of old versions that no partition points to.

Works on whatever catalog the session has (a metastore, or the session's own).
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import _as_date, in_window
from . import sinks as SK

VERSIONS = "_versions"


def ensure_catalog_table(spark: SparkSession, name: str, schema, location: str, partition_col: str = "date") -> bool:
    """Create an external Parquet table partitioned by date if there is none.
    True when it was created."""
    if spark.catalog.tableExists(name):
        return False
    columns = spark.createDataFrame([], schema)._jdf.schema().toDDL()
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({partition_col}) LOCATION '{location}'")
    return True


def table_location(spark: SparkSession, name: str, day: str | None = None, partition_col: str = "date") -> str:
    """Folder of a table, or of one of its dates."""
    part = f" PARTITION ({partition_col}='{day}')" if day else ""
    rows = spark.sql(f"DESCRIBE FORMATTED {name}{part}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def partition_dates(spark: SparkSession, name: str) -> set[str]:
    return {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def _point(spark: SparkSession, name: str, day: str, had: bool, folder: str | None, partition_col: str) -> None:
    """The one call that replaces a date."""
    part = f"PARTITION ({partition_col}='{day}')"
    if folder is None:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {part}")
    elif had:
        spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part} LOCATION '{folder}'")


def replace_partitions(fresh: DataFrame, name: str, start, end, cluster_by=(), partition_col: str = "date",
                       tie_breaker: str | None = None, max_records_per_file: int | None = None,
                       large: bool = True) -> list[date]:
    """Delete+insert of ``[start, end)`` on a catalog table. ``fresh`` may read
    the table itself: its old folders stay. Rows outside the window, or
    without a date, are refused, as a repeated run would insert them again.
    Returns the window dates left empty."""
    spark = fresh.sparkSession
    root = table_location(spark, name)
    window = [d.isoformat() for d in SK.date_range(start, end)]
    with SK.writer_lock(spark, root):
        version = f"{root}/{VERSIONS}/{uuid.uuid4().hex}"
        out = SK.clustered(fresh, cluster_by, partition_col, tie_breaker, large)
        SK._writer(out, partition_col, max_records_per_file).mode("errorifexists").save(version)
        staged = {n.split("=", 1)[1] for n in SK._list_dirs(spark, version) if n.startswith(f"{partition_col}=")}
        if staged - set(window):
            SK.remove_dir(spark, version)
            raise ValueError(f"rows outside the window: {sorted(staged - set(window))[:5]}")
        had = partition_dates(spark, name)
        for day in window:
            if day in staged or day in had:
                _point(spark, name, day, day in had, f"{version}/{partition_col}={day}" if day in staged else None,
                       partition_col)
    return [_as_date(day) for day in window if day in had and day not in staged]


def read_partitions(spark: SparkSession, name: str, start=None, end=None, partition_col: str = "date") -> DataFrame:
    return spark.table(name).where(in_window(F.col(partition_col), start, end))


def vacuum(spark: SparkSession, name: str, keep_minutes: float = 24 * 60, partition_col: str = "date") -> list[str]:
    """Delete version folders older than ``keep_minutes`` (running queries may
    still read younger ones) that no partition points to. Returns them. The
    loop is over folders of dates, never over rows."""
    root = table_location(spark, name)
    with SK.writer_lock(spark, root):
        had, gone = partition_dates(spark, name), []
        fs, _ = SK._fs_path(spark, root)
        limit = spark.sparkContext._jvm.java.lang.System.currentTimeMillis() - keep_minutes * 60_000
        for version in SK.glob(spark, f"{root}/{VERSIONS}/*"):
            if fs.getFileStatus(SK._fs_path(spark, version)[1]).getModificationTime() > limit:
                continue
            folders = SK.glob(spark, f"{version}/{partition_col}=*")
            for folder in folders:
                day = folder.rsplit("=", 1)[1]
                if day not in had or table_location(spark, name, day, partition_col) != folder:
                    SK.remove_dir(spark, folder)
                    gone.append(folder)
            if all(f in gone for f in folders):
                SK.remove_dir(spark, version)
    return gone
