"""The corpus pipeline: five stages over ``documents``, each on all its
predecessor kept.

Quality rules drop the documents they reject; line dedup takes repeated
passages out of later documents and drops documents of which nothing is left;
SimHash near-dedup keeps one document of each group; mixing repeats or leaves
out whole documents towards the sources' weights; BPE encodes and decodes what
is left. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstat.llm import bpe, line_dedup, mixing, quality, simhash
from tickstat.llm.common import row_key, write_once
from tickstat.session import checkpoint_dir, delete_at_exit


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id, source, text`` and all other columns in a struct, so that no
    column of the documents can clash with one of an operator."""
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "source", "text")]
    return docs.select("doc_id", "source", "text", F.struct(*rest, F.lit(0).alias("_")).alias("_rest"))


def unpacked(df: DataFrame, docs: DataFrame) -> DataFrame:
    own = ("doc_id", "source", "text")
    return df.select(*(F.col(c) if c in own else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and the log-likelihood ratio and
    are not marked toxic."""
    judged = quality.judge(packed(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return unpacked(judged.where("_kept AND NOT _toxic"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that earlier documents have; ``n_chars`` of
    a changed text is its new length. A document whose lines all go is dropped."""
    found = line_dedup.dedup(packed(docs)).where("_n_removed = 0 OR _n_removed < _n_lines")
    if "n_chars" not in docs.columns:
        return unpacked(found, docs)
    length = F.when(F.col("_n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("_rest.n_chars"))
    changed = found.withColumn("_rest", F.col("_rest").withField(
        "n_chars", length.cast(docs.schema["n_chars"].dataType)))
    return unpacked(changed, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest id, NULL ids last, equal ids
    by the hash of id and text, one of repeated rows. The choice is made over
    ids, keys and fingerprints with partial minima; the texts move once."""
    keyed = docs.select(F.struct("doc_id", row_key().alias("key")).alias("doc_id"), "text")
    fps = write_once(simhash.fingerprints(keyed).select("doc_id.*", "fp"), "near-dedup")
    groups = simhash.near_groups(fps).select("fp", "root")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    best = fps.join(groups, "fp").groupBy("root").agg(F.min(place).alias("best")).select(F.col("best.key").alias("_key"))
    kept = packed(docs).withColumn("_key", row_key()).join(best, "_key", "left_semi")
    return unpacked(kept.dropDuplicates(["_key"]), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in as many copies as the mix takes of their words:
    taken / size, rounded up with the probability of its fraction by a hash of
    the document. A document without words has no part in a mix and goes.
    Repeated rows (same id, text and source) are one document that has all
    their copies."""
    key = F.md5(F.concat_ws("|", row_key(), F.coalesce(F.col("source").cast("string"), F.lit("-"))))
    keyed = packed(docs).withColumn("_key", key)
    mixed = mixing.mix(keyed, id_column="_key")["documents"]
    unit = F.pmod(F.xxhash64("place", F.lit("copies")), F.lit(1 << 30)) / (1 << 30)
    copies = F.floor(F.col("taken") / F.col("size") + unit).cast("int")
    times = (mixed.where("size > 0 AND taken > 0").groupBy(F.col("doc_id").alias("_key"))
             .agg(F.sum(copies).cast("int").alias("_copies")).where("_copies > 0"))
    return unpacked(keyed.join(times, "_key").dropDuplicates(["_key"])
                    .withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded text."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", encode),
]

# patience alignment, Hamming search, seeded draws and BPE have no SQL form;
# tests/llm/test_pipeline.py checks the run against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's result is written to the
    shared folder and reread as the next one's documents. The folders go when
    the driver ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        delete_at_exit(spark, f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
