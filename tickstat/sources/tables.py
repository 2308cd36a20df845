"""Reading input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """``<directory>/<name>.parquet`` as it is."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")
