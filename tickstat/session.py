"""Spark session settings the library relies on.

Every function in the package is a plain DataFrame -> DataFrame transform and
works on any session; ``configure`` applies the settings whose defaults would
change results or hurt at scale:

* session time zone UTC: ``DATE(ts)`` and hour buckets are UTC in the source;
* ANSI mode on: bad casts and division by zero raise unless ``try_*`` is used,
  which is how the guarded expressions in ``functions`` are written;
* dynamic partition overwrite: replacing one ``date=`` folder must not wipe the
  others (the default STATIC mode would);
* AQE with partition coalescing and skew-join splitting: shuffle sizes are
  chosen at run time, and joins whose small side turns out to be under the
  broadcast threshold are converted to broadcast joins after Spark has
  measured the real size (the only broadcast path used by the library).
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Spark applies ``spark.checkpoint.dir`` when the context starts; that value
    is used as is. A session without one gets a folder in its warehouse. On a
    cluster that has to be a shared one: a warehouse on the driver's disk, which
    executors cannot read, is refused. A local session has one machine.
    """
    fallback = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    try:
        sc = spark.sparkContext
    except Exception:   # noqa: BLE001 - Spark Connect: no context on the client
        return spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", sc.master) and re.match(r"(file:|/)", fallback):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share; {fallback} is the driver's")
        sc.setCheckpointDir(named or fallback)
    return sc.getCheckpointDir()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tickstat", checkpoint: str | None = None,
                  event_log: str | None = None) -> SparkSession:
    """Session for tests and the local bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TICKSTAT_DRIVER_MEMORY", "8g"))
    )
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    if event_log:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log)
                   .config("spark.eventLog.compress", "false"))
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str = "step", path: str | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a DataFrame reading it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor re-reads the
    files instead of recomputing the plan) but runs the plan once and stores
    it columnar, so later steps read only the columns they use.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.format("parquet").save(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system delete a folder when the driver ends (not when it
    is killed). For tables behind lazy results, which nothing can delete before."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
