"""Ranks within groups that no task can hold.

A window function needs all rows of a group in one task. Here the rows are
dealt by ranges of (group, order), so a large group spans many parts and a
part holds many small groups: rows are ranked inside their part, and the rank
is raised by the rows of the group in the parts before. What any one task
sorts is a part of the size Spark gives its range partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

PART = "_part"


def deal(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``df`` with the number of its range of (group, order) in ``_part``.

    Written twice to the shared folder: range partitioning reads its input two
    times (to find the ranges, then to deal), and the number of a range is only
    settled once it is stored."""
    once = materialize(df, "rank_input")
    dealt = once.repartitionByRange(*[F.col(g) for g in group], *order)
    return materialize(dealt.withColumn(PART, F.spark_partition_id()), "rank_parts")


def rank(dealt: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """What ``row_number() OVER (PARTITION BY group ORDER BY order)`` gives, as
    ``name``, for rows from ``deal``. Of rows that are equal in all of ``order``
    any may come first."""
    inside = Window.partitionBy(PART, *group).orderBy(*order)
    counts = dealt.groupBy(PART, *group).agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(ahead), F.lit(0))).drop("_rows")
    local = dealt.withColumn("_inside", F.row_number().over(inside))
    return (join_groups(local, before, [PART, *group])
            .withColumn(name, (F.col("_before") + F.col("_inside")).cast("long")).drop("_before", "_inside"))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with the columns of its group; NULL is a group like any other."""
    named = groups.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(Column.__and__, [rows[k].eqNullSafe(named[f"_k_{k}"]) for k in keys])
    return rows.join(named, same).drop(*[f"_k_{k}" for k in keys])
