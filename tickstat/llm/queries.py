"""The registered queries: each applies one operator, with production
parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (align, bpe, fingerprints, jaccard, langid, licenses, line_dedup, manifest, mixing, quality, secrets,
               simhash, token_counts)
from .common import read
from .oracle import oracle_sql

__all__ = ["oracle_sql", "queries"]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents whose checksum is not 2 modulo 4."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = langid.train(docs.where(~held_out).select("lang", "text"))
    return langid.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits", "accepted")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), VOCABULARY, PATTERN)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < secrets.KINDS.index("live"))

    def counted(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long")

    return found.select("doc_id", *(counted(k).alias(f"n_{k}") for k in secrets.KINDS[:3]),
                        F.sha2(secrets.span_string(base), 256).alias("base_sha256"),
                        secrets.span_string(F.col("spans")).alias("spans"), counted("live").alias("n_live"),
                        F.size(F.filter(base, lambda s: s["label"] == "example")).cast("long").alias("n_example"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
                        F.array_join(F.col("_partners").cast("array<string>"), ",").alias("partners"), "text")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score",
             "toxic", "toxicity")
    return judged.select("doc_id", *(F.col(f"_{n}").alias(n) for n in names))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(read(spark, sf_dir, "documents"), VOCABULARY, PATTERN)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))["documents"].select(
        "doc_id", "size", "source_size", "target", "taken")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edited(read(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("group_id").alias("component_id"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return manifest.build(docs, manifest.tampered()).proofs().select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                       public_tokenizers.path("piece_bpe_32k.model"), pattern=PATTERN)


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_documents(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
