"""Incremental load of landed hourly files into the raw order-book table, and
reload of whole landing folders, agreeing through a ledger of files.

The table's layout is ``<table>/date=<date of the row>/src=<landing folder>/
load=<id>/*.parquet``; ``_ledger/files/src=/load=`` holds one row per landed
file and row date: ``(file, modified, date, rows)``, and ``_ledger/ids`` the
market ids of each date. Both ways of loading write them, and both look at the
files:

* ``load_landed``: a file stream with ``availableNow`` finds the files that
  have landed since its last run. Files the ledger has are left out of the
  micro-batch, so what a reload brought in is not loaded a second time, nor is
  anything after the stream's memory was lost. A micro-batch writes its own
  ``load=b<number>`` folders and overwrites them when it is run again.
* ``reload_dates``: replaces everything that came from a landing folder by what
  the folder holds now, wherever its rows lie. Rows that lie in a date of the
  window but came from another folder stay. Each folder is a run of its own; a
  failing one keeps its old rows, the others go on.

A reload becomes visible as a whole by the creation of one empty file: its rows
are written under a load that ``scan_raw`` hides while it is pending, the
creation of ``_ledger/reloads/<id>`` shows it and hides the loads before it,
and only then are those deleted. Nothing is moved. A run that was stopped is
put right by the next writer (``recover``); readers see whole folders, old or
new, at any time. A lock file keeps a second writer out.

The stream's memory lies in the table (``_checkpoint``, ignored by readers).
Files are clustered by market and update type, which lets readers skip files
by their statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.columns import in_window
from ..operators import sinks as SK
from ..session import materialize, scratch_path
from ..sources.raw import LEDGER, live_rows, reload_state

LANDED = T.StructType(S.RAW_ORDERBOOK.fields + [T.StructField("date", T.DateType())])
CLUSTER = ["market_id", "update_type"]
FILES = T.StructType([T.StructField("file", T.StringType()), T.StructField("modified", T.TimestampType()),
                      T.StructField("date", T.DateType()), T.StructField("rows", T.LongType()),
                      T.StructField("src", T.DateType()), T.StructField("load", T.StringType())])
IDS = T.StructType([T.StructField("market_id", T.StringType()), T.StructField("date", T.DateType()),
                    T.StructField("src", T.DateType()), T.StructField("load", T.StringType())])
# a file is named by its folder and name, however the landing root is written
_FILE = r"([^/]+/[^/]+)$"


class LoadFailures(RuntimeError):
    """Some landing folders could not be loaded; ``failed`` lists them."""

    def __init__(self, failed: list[tuple]):
        self.failed = sorted(failed)
        super().__init__("failed dates: " + "; ".join(f"{d}: {why}" for d, why in self.failed))


# ------------------------------------------------------------------ reading
def _named(landed: DataFrame) -> DataFrame:
    """Raw columns, row date, landing folder, and the file each row is from."""
    return landed.select(*[F.col(f.name) for f in S.RAW_ORDERBOOK.fields],
                         F.to_date("timestamp_received").alias("date"), F.col("date").alias("src"),
                         F.regexp_extract("_metadata.file_path", _FILE, 1).alias("file"),
                         F.col("_metadata.file_modification_time").alias("modified"))


def landed_stream(spark: SparkSession, landing_root: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over ``<landing_root>/date=YYYY-MM-DD/*.parquet``."""
    reader = spark.readStream.schema(LANDED).option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _named(reader.parquet(landing_root))


def landed_folder(spark: SparkSession, landing_root: str, day) -> DataFrame:
    """What the landing folder of a date holds now; without rows if it is not
    there."""
    folder = f"{landing_root.rstrip('/')}/date={day.isoformat()}"
    if not SK._exists(spark, folder):
        return spark.createDataFrame([], T.StructType([
            *S.RAW_ORDERBOOK.fields, *(f for f in FILES.fields if f.name in ("date", "src", "file", "modified"))]))
    return _named(spark.read.schema(LANDED).option("basePath", landing_root).option("pathGlobFilter", "*.parquet")
                  .parquet(folder))


def ledger(spark: SparkSession, raw_table: str) -> DataFrame:
    """``(file, modified, date, rows, src, load)``: the files in the table."""
    path = f"{raw_table.rstrip('/')}/{LEDGER}/files"
    if not SK._exists(spark, path):
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).parquet(path)


def changed_files(spark: SparkSession, landing_root: str, raw_table: str) -> DataFrame:
    """``(src, file, modified, loaded)`` of the landed files that were written
    again after they had been loaded: their folders want a reload. Reads file
    metadata and the ledger, no data column."""
    landed = (spark.read.schema(LANDED).option("basePath", landing_root).option("pathGlobFilter", "*.parquet")
              .parquet(landing_root)
              .select(F.col("date").alias("src"), F.regexp_extract("_metadata.file_path", _FILE, 1).alias("file"),
                      F.col("_metadata.file_modification_time").alias("modified")).distinct())
    loaded = ledger(spark, raw_table).groupBy("file").agg(F.max("modified").alias("loaded"))
    return landed.join(loaded, "file").where("modified > loaded").select("src", "file", "modified", "loaded")


def market_ids(spark: SparkSession, raw_table: str, start=None, end=None) -> DataFrame:
    """``(market_id, timestamp_received)``: the distinct market ids of the rows
    of each date in ``[start, end)``, with the date's start, kept by the loads:
    discovery of new markets over any range, or the whole table, reads no
    order-book row. A reload under way is seen as a whole or not at all."""
    root = raw_table.rstrip("/")
    path = f"{root}/{LEDGER}/ids"
    while True:
        state = reload_state(spark, root)
        df = (spark.read.schema(IDS).parquet(path) if SK._exists(spark, path)
              else spark.createDataFrame([], IDS))
        if state == reload_state(spark, root):
            break
    return (df.where(live_rows(*state)).where(in_window("date", start, end))
            .select("market_id", F.col("date").cast("timestamp").alias("timestamp_received")).distinct())


# ------------------------------------------------------------------ writing
def _contents(rows: DataFrame) -> DataFrame:
    """Rows per file, row date and market, for the ledger."""
    return rows.groupBy("file", "modified", "date", "src", "market_id").agg(F.count(F.lit(1)).alias("rows"))


def _write(rows: DataFrame, root: str, load: str, mode: str) -> None:
    names = [f.name for f in S.RAW_ORDERBOOK.fields]
    (rows.select(*names, "date", "src", F.lit(load).alias("load")).hint("rebalance", "date", *CLUSTER)
     .sortWithinPartitions("date", "src", *CLUSTER)
     .write.partitionBy("date", "src", "load").option("partitionOverwriteMode", "dynamic").mode(mode).parquet(root))


def _note(contents: DataFrame, root: str, load: str, mode: str) -> None:
    """Enter files and the ids of their rows into the ledger, the files last:
    a file that is in it has its ids there."""
    ids = contents.select("market_id", "date", "src").distinct()
    files = contents.groupBy("file", "modified", "date", "src").agg(F.sum("rows").alias("rows"))
    for kind, rows in (("ids", ids.repartition("src")), ("files", files.coalesce(1))):
        (rows.withColumn("load", F.lit(load)).write.partitionBy("src", "load")
         .option("partitionOverwriteMode", "dynamic").mode(mode).parquet(f"{root}/{LEDGER}/{kind}"))


def load_landed(spark: SparkSession, landing_root: str, raw_table: str,
                checkpoint_location: str | None = None,
                max_files_per_trigger: int | None = None) -> dict | None:
    """Add every newly landed file to ``raw_table`` and stop.

    ``checkpoint_location`` is where the stream keeps its memory, the table's
    own ``_checkpoint`` folder by default; give the same one in every run.
    Returns the last progress report (None when there was nothing new)."""
    root = raw_table.rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        load, path = f"b{number:09d}", scratch_path(spark, "landed_files")
        try:
            contents = materialize(_contents(batch), path=path)
            known = ledger(spark, root).where(F.col("load") != load).select("file")
            # one name per file of the batch that is in the table already; as a rule none
            again = [r["file"] for r in contents.join(known, "file", "left_semi").select("file").distinct().collect()]
            fresh = ~F.col("file").isin(again) if again else F.lit(True)
            _write(batch.where(fresh), root, load, "overwrite")
            _note(contents.where(fresh), root, load, "overwrite")
        finally:
            SK.remove_dir(spark, path)

    with SK.writer_lock(spark, root):
        recover(spark, root)
        query = (landed_stream(spark, landing_root, max_files_per_trigger).writeStream
                 .foreachBatch(write)
                 .option("checkpointLocation", checkpoint_location or f"{root}/_checkpoint")
                 .trigger(availableNow=True)
                 .start())
        query.awaitTermination()
    return query.lastProgress


def _loads(spark: SparkSession, root: str, src: str) -> dict[str, list[str]]:
    """Folders of a landing folder's rows and ledger entries, by load."""
    found: dict[str, list[str]] = {}
    for pattern in (f"{root}/date=*/src={src}/load=*", f"{root}/{LEDGER}/*/src={src}/load=*"):
        for path in SK.glob(spark, pattern):
            found.setdefault(path.rsplit("load=", 1)[1], []).append(path)
    return found


def _older(load: str, reload_id: str, upto: str) -> bool:
    return load <= upto if load.startswith("b") else load < reload_id


def recover(spark: SparkSession, raw_table: str) -> list[str]:
    """Put right what a stopped reload left: one that was not committed goes,
    one that was has the loads it replaced deleted. Returns their names."""
    root = raw_table.rstrip("/")
    pending, commits = reload_state(spark, root)
    for name in pending:
        _finish(spark, root, name, commits.get(name))
    return sorted(pending)


def _finish(spark: SparkSession, root: str, name: str, upto: str | None) -> None:
    """Delete the loads that a reload replaced, or its own if it has no commit,
    then its marks. Can be repeated after a stop at any point."""
    reload_id, src = name.split(".")
    for load, folders in _loads(spark, root, src).items():
        if _older(load, reload_id, upto) if upto is not None else load == reload_id:
            for folder in folders:
                SK.remove_dir(spark, folder)
    SK.remove_dir(spark, f"{root}/{LEDGER}/pending/{name}")      # first: a commit without it changes nothing
    if upto is not None:
        SK.remove_dir(spark, f"{root}/{LEDGER}/reloads/{name}.{upto}")


def reload_folder(spark: SparkSession, landing_root: str, raw_table: str, day) -> None:
    """Replace all rows that came from the landing folder of ``day``. The
    caller holds the table's lock."""
    root, src = raw_table.rstrip("/"), day.isoformat()
    had = _loads(spark, root, src)
    number = 1 + max([0, *(int(load[1:]) for load in had if load.startswith("r"))])
    reload_id, upto = f"r{number:09d}", max([load for load in had if load.startswith("b")], default="b")
    name = f"{reload_id}.{src}"
    SK.create_mark(spark, f"{root}/{LEDGER}/pending/{name}")
    rows, path = landed_folder(spark, landing_root, day), scratch_path(spark, "landed_files")
    try:
        _write(rows, root, reload_id, "append")
        _note(materialize(_contents(rows), path=path), root, reload_id, "append")
    finally:
        SK.remove_dir(spark, path)
    SK.create_mark(spark, f"{root}/{LEDGER}/reloads/{name}.{upto}")         # the commit
    _finish(spark, root, name, upto)


def reload_dates(spark: SparkSession, landing_root: str, raw_table: str, start, end,
                 raise_on_failure: bool = True) -> DataFrame:
    """Replace what came from the landing folders of ``[start, end)`` by what
    they hold now. Returns one row per folder: ``(date, rows_before,
    rows_after, error)``; a folder that could not be read keeps its rows, has
    its reason in ``error``, and with ``raise_on_failure`` is reported by a
    ``LoadFailures`` after all others were done. Folders that are gone leave
    no rows."""
    root = raw_table.rstrip("/")
    days = SK.date_range(start, end)

    def counted() -> dict:
        """Rows per folder, one row each to the driver."""
        found = ledger(spark, root).where(F.col("src").isin(days) if days else F.lit(False))
        return {r["src"]: r["n"] for r in found.groupBy("src").agg(F.sum("rows").alias("n")).collect()}

    failed: dict = {}
    with SK.writer_lock(spark, root) as lock:
        recover(spark, root)
        before = counted()
        for day in days:
            lock.renew()
            try:
                reload_folder(spark, landing_root, root, day)
            except Exception as exc:   # noqa: BLE001 - collected per date, reported below
                failed[day] = f"{type(exc).__name__}: {str(exc)[:200]}"
                recover(spark, root)
        after = counted()
    if failed and raise_on_failure:
        raise LoadFailures(list(failed.items()))
    return spark.createDataFrame([(d, before.get(d, 0), after.get(d, 0), failed.get(d)) for d in days],
                                 "date date, rows_before long, rows_after long, error string")
