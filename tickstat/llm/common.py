"""What several operators share: row keys, tables in the shared folder, ASCII
lower case, connected components.

Conventions of every operator in this package:

* a NULL text counts as an empty one; NULL ids, sources and languages are
  ordinary values;
* one result row per input row, also for repeated rows, which get equal
  results;
* an operator reads the columns it names and ignores all others, so extra
  columns (also ones named like a result column) cannot clash;
* an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, delete_at_exit


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Run ``df`` once into the folder the cluster shares and read it back:
    cuts the lineage, survives lost executors, and several readers do not
    repeat the work. The folder goes when the driver ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128-bit key of a row's id and text (NULL and empty text: the same).
    Repeated rows share it, and so share their result."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")),
                             F.coalesce(F.col(text), F.lit(""))))


def ascii_lower(text: Column) -> Column:
    """Lower case whose ASCII part changes only A-Z. The Kelvin sign is the
    one non-ASCII letter whose lower case is a plain ASCII letter, so it is
    moved away first."""
    return F.lower(F.replace(text, F.lit("K"), F.lit("ǩ")))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``(a, b)`` long pairs: ``(node, root)`` for
    every node that is not itself the smallest of its component.

    Alternating large and small stars: every round keeps connectivity, moves
    each node towards the smallest one it can see and needs a number of
    rounds logarithmic in the longest chain. A round is two groupings with
    map-side minima and two joins; its edges are written to the shared folder.
    """
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    now = write_once(edges.select(hi.alias("u"), lo.alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        now = write_once(small, "edges")
