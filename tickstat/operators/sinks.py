"""Idempotent writers for date-partitioned Parquet tables.

* ``window_replace``  - delete+insert on the date key as a DataFrame operation
  (every date of the window is replaced, including dates that have no fresh
  rows: those end up empty, unlike a plain dynamic overwrite).
* ``write_window``    - the same on a Parquet table: one staged write of the
  fresh rows, then a per-date folder swap; window dates without fresh rows
  lose their folder.
* ``overwrite_partitions`` - replace exactly the date partitions present in
  the DataFrame (the raw-table load).
* ``insert_only_merge`` - insert unmatched keys, never update.

Layout (``clustered``): large tables are rebalanced on (date, cluster keys)
and sorted within partitions, so each date folder holds files covering
contiguous key ranges (Parquet min/max statistics then prune reads on the
cluster keys). AQE sizes the rebalance from
``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and splits a skewed key
over several tasks; no explicit partition count is set.
"""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import _as_date, in_window


# --------------------------------------------------------------- DataFrame
def window_replace(existing: DataFrame, fresh: DataFrame, start, end,
                   key: str = "date") -> DataFrame:
    """Rows of ``existing`` outside ``[start, end)`` plus all ``fresh`` rows.
    A NULL date lies outside every window, so its rows stay."""
    kept = existing.where(~F.coalesce(in_window(key, start, end), F.lit(False)))
    return kept.unionByName(fresh)


def insert_only_merge(target: DataFrame, source: DataFrame, key: str | list[str] = "market_id",
                      dedup: bool = False) -> DataFrame:
    """``target`` plus the ``source`` rows whose key is not in ``target``.

    Every unmatched source row is inserted, also several of a key. ``dedup``
    keeps one source row per key (the smallest by the remaining columns, so
    the choice is deterministic), which stops duplicated keys from fanning out
    later joins.
    """
    return target.unionByName(merge_inserts(target, source, key, dedup))


def merge_inserts(target: DataFrame, source: DataFrame, key: str | list[str] = "market_id",
                  dedup: bool = False) -> DataFrame:
    """Only the rows ``insert_only_merge`` adds."""
    keys = [key] if isinstance(key, str) else list(key)
    new = source.join(target.select(*keys), keys, "left_anti")
    if dedup:
        new = dedup_by_key(new, keys)
    return new


def dedup_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; the smallest row wins. A ``min`` over a struct is a
    partial aggregate, so a key duplicated millions of times is still reduced
    map-side rather than gathered into one task."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


# ------------------------------------------------------------------ layout
def clustered(df: DataFrame, cluster_by=(), partition_col: str = "date",
              tie_breaker: str | None = None, large: bool = True) -> DataFrame:
    """Layout for a date-partitioned write.

    ``large`` (tick-sized tables): a REBALANCE on (date, cluster keys) - a
    hash shuffle whose output AQE sizes to
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, splitting a skewed
    partition (a market holding a third of the day) over several tasks and
    merging small ones - then a sort within each task on (date, keys,
    tie-breaker), so files hold contiguous key ranges for min/max pruning.
    Unlike range partitioning there is no sampling job, which would compute
    the upstream plan (the JSON parse) twice. Otherwise (facts with one row
    per market-day or less): hash on the date only, one sorted file per date.
    """
    keys = [partition_col, *cluster_by]
    order = keys + ([tie_breaker] if tie_breaker else [])
    if large:
        return df.hint("rebalance", *keys).sortWithinPartitions(*order)
    return df.repartition(partition_col).sortWithinPartitions(*order)


def _writer(df: DataFrame, partition_col: str, max_records_per_file: int | None):
    w = df.write.format("parquet").partitionBy(partition_col)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w


def overwrite_partitions(df: DataFrame, path: str, cluster_by=(), partition_col: str = "date",
                         tie_breaker: str | None = None,
                         max_records_per_file: int | None = None,
                         large: bool = True) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite);
    other dates are untouched."""
    out = clustered(df, cluster_by, partition_col, tie_breaker, large)
    (_writer(out, partition_col, max_records_per_file)
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").save(path))


def overwrite_dates(df: DataFrame, path: str, start, end, cluster_by=(),
                    partition_col: str = "date", raise_on_failure: bool = True, **kw) -> list:
    """Reload a window one date at a time (the source's per-date load loop):
    each date is its own dynamic-overwrite job, a failing date does not stop
    the others, and the failed dates are returned (or raised at the end).
    The loop runs over the window's dates - metadata, never rows."""
    failed = []
    for day in date_range(start, end):
        try:
            overwrite_partitions(df.where(F.col(partition_col) == F.lit(day)), path, cluster_by,
                                 partition_col, **kw)
        except Exception as exc:   # noqa: BLE001 - collected per date, reported below
            failed.append((day, f"{type(exc).__name__}: {str(exc)[:200]}"))
    if failed and raise_on_failure:
        raise RuntimeError("failed partitions: " + ", ".join(str(d) for d, _ in failed))
    return failed


NULL_DATE = "__HIVE_DEFAULT_PARTITION__"


def write_window(fresh: DataFrame, path: str, start, end, cluster_by=(),
                 partition_col: str = "date", tie_breaker: str | None = None,
                 max_records_per_file: int | None = None, large: bool = True) -> list[date]:
    """Delete+insert of ``[start, end)`` on a date-partitioned Parquet table.

    The fresh rows are written once, to a staging folder inside the table
    (``_staging-*``: ignored by readers), then swapped in date by date: a
    window date with staged rows replaces its folder, a window date without
    staged rows loses its folder, and staged dates outside the window are
    appended to (as the source inserts whatever the query returns). Rows
    without a date belong to no window; a run replaces the ones that are
    there, so that a repeated run does not add them again. Returns the window
    dates left empty. ``fresh`` must not be a lazy read of ``path``. A lock file
    keeps a second writer out (``TableLocked``). Readers can miss a date while
    it is swapped; where that matters, ``catalog.replace_partitions`` has no
    such moment.

    A replaced folder is moved aside, the new one moved in, and only then is
    the old one deleted; a run that was stopped in between is put right at the
    start of the next one (``recover``).
    """
    spark = fresh.sparkSession
    root = path.rstrip("/")
    with writer_lock(spark, root):
        recover(spark, root)
        return _write_window(fresh, root, start, end, cluster_by, partition_col, tie_breaker,
                             max_records_per_file, large)


def _write_window(fresh: DataFrame, root: str, start, end, cluster_by, partition_col: str,
                  tie_breaker: str | None, max_records_per_file: int | None, large: bool) -> list[date]:
    spark = fresh.sparkSession
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    out = clustered(fresh, cluster_by, partition_col, tie_breaker, large)
    _writer(out, partition_col, max_records_per_file).mode("errorifexists").save(staging)
    _mkdirs(spark, root)
    staged = {name.split("=", 1)[1]: f"{staging}/{name}"
              for name in _list_dirs(spark, staging) if name.startswith(f"{partition_col}=")}
    window = {d.isoformat() for d in date_range(start, end)}
    emptied = []
    for day in sorted(window | ({NULL_DATE} & set(staged))):
        had = swap_folder(spark, root, f"{partition_col}={day}", staged.get(day))
        if had and day not in staged:
            emptied.append(_as_date(day))
    for day in sorted(set(staged) - window - {NULL_DATE}):     # rows outside the window: insert
        target = f"{root}/{partition_col}={day}"
        _mkdirs(spark, target)
        for name in _list_files(spark, staged[day]):
            _rename(spark, f"{staged[day]}/{name}", f"{target}/{name}")
    _delete_dir(spark, staging)
    return emptied


ASIDE = "_aside"


def swap_folder(spark, root: str, name: str, fresh: str | None) -> bool:
    """Put the folder ``fresh`` (or nothing) in the place of ``root/name``:
    old aside, new in, old deleted. True if there was an old one."""
    target, aside = f"{root}/{name}", f"{root}/{ASIDE}/{name}"
    had = _exists(spark, target)
    if had:
        _mkdirs(spark, f"{root}/{ASIDE}")
        _rename(spark, target, aside)
    if fresh:
        _rename(spark, fresh, target)
    if had:
        _delete_dir(spark, aside)
    return had


def recover(spark, root: str) -> list[str]:
    """Undo what a stopped ``write_window`` left in the table: a folder that
    was moved aside and not yet replaced goes back, other leftovers go.
    Returns the folders put back; their window has to be run again."""
    if not _exists(spark, root):
        return []
    back = []
    if _exists(spark, f"{root}/{ASIDE}"):
        for name in _list_dirs(spark, f"{root}/{ASIDE}"):
            if not _exists(spark, f"{root}/{name}"):
                _rename(spark, f"{root}/{ASIDE}/{name}", f"{root}/{name}")
                back.append(name)
        _delete_dir(spark, f"{root}/{ASIDE}")
    for name in _list(spark, root, True, hidden=True):
        if name.startswith("_staging-"):
            _delete_dir(spark, f"{root}/{name}")
    return back


def ensure_table(spark, path: str, schema, partition_col: str | None = "date") -> bool:
    """Create an empty Parquet table with ``schema`` if ``path`` is absent.
    Returns True when it was created."""
    if _exists(spark, path):
        return False
    w = spark.createDataFrame([], schema).write.format("parquet").mode("errorifexists")
    if partition_col and partition_col in schema.fieldNames():
        w = w.partitionBy(partition_col)
    w.save(path)
    return True


def append_inserts(target_path: str, source: DataFrame, key="market_id", dedup=False) -> None:
    """Insert-only merge into a Parquet table: only unmatched keys are
    appended, existing rows are never rewritten. A lock file keeps a second
    merge out, which would insert the same keys."""
    spark = source.sparkSession
    from ..session import materialize, scratch_path
    path = scratch_path(spark, "merge_inserts")
    with writer_lock(spark, target_path):
        inserts = merge_inserts(spark.read.parquet(target_path), source, key, dedup)
        try:
            # cuts the lineage to the table being appended to
            materialize(inserts, path=path).write.format("parquet").mode("append").save(target_path)
        finally:
            remove_dir(spark, path)


# ------------------------------------------------------------- one writer
class TableLocked(RuntimeError):
    """Another writer holds the table."""


class writer_lock:     # noqa: N801 - used as a context manager only
    """Holds ``<table>/_lock`` while a table is written. The file is created
    only if it is not there, which file systems do for one caller alone. A
    lock that has not been renewed for ``lease_minutes`` was left by a writer
    that died and is taken over."""

    def __init__(self, spark, root: str, lease_minutes: float = 60):
        self.spark, self.path, self.lease = spark, f"{root.rstrip('/')}/_lock", lease_minutes * 60_000

    def __enter__(self):
        if not create_mark(self.spark, self.path):
            fs, p = _fs_path(self.spark, self.path)
            age = self._now() - fs.getFileStatus(p).getModificationTime()
            if age < self.lease:
                raise TableLocked(f"{self.path} is {age // 1000} s old")
            fs.delete(p, False)
            if not create_mark(self.spark, self.path):
                raise TableLocked(f"{self.path} was taken by another writer")
        return self

    def __exit__(self, *exc) -> None:
        _delete_dir(self.spark, self.path)

    def _now(self) -> int:
        return self.spark.sparkContext._jvm.java.lang.System.currentTimeMillis()

    def renew(self) -> None:
        fs, p = _fs_path(self.spark, self.path)
        fs.setTimes(p, self._now(), -1)


def create_mark(spark, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    fs, p = _fs_path(spark, path)
    try:
        fs.create(p, False).close()
    except Exception:   # noqa: BLE001 - the JVM's exists-already error, or a real one
        if not fs.exists(p):
            raise
        return False
    return True


# ------------------------------------------------------------- file system
def date_range(start, end) -> list[date]:
    """Dates of a half-open window (metadata only, never data)."""
    s, e = _as_date(start), _as_date(end)
    return [s + timedelta(days=i) for i in range((e - s).days)]


def _fs_path(spark, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def _exists(spark, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def _delete_dir(spark, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def _mkdirs(spark, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.mkdirs(p)


def _rename(spark, src: str, dst: str) -> None:
    fs, p = _fs_path(spark, src)
    if not fs.rename(p, _fs_path(spark, dst)[1]):
        raise OSError(f"rename {src} -> {dst} failed")


def _list(spark, path: str, dirs: bool, hidden: bool = False) -> list[str]:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if bool(st.isDirectory()) == dirs
            and (hidden or not st.getPath().getName().startswith(("_", ".")))]


def glob(spark, pattern: str) -> list[str]:
    """Paths that match a pattern."""
    fs, p = _fs_path(spark, pattern)
    return [st.getPath().toString() for st in fs.globStatus(p) or []]


def _list_dirs(spark, path: str) -> list[str]:
    return _list(spark, path, True)


def _list_files(spark, path: str) -> list[str]:
    return _list(spark, path, False)


def remove_dir(spark, path: str) -> bool:
    """Delete a folder (recursively) if it exists."""
    return _delete_dir(spark, path)
