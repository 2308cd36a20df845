"""Quality rules and a hashed n-gram log-likelihood ratio, all in SQL functions.

Base rules: word, symbol and repetition counts of every whole text.

The method: words and word pairs are hashed into ``BUCKETS`` buckets and
counted over all documents (the raw corpus) and over trusted documents (the
target). A document's score is the mean over its n-grams of
``log(target share / raw share)`` of their buckets. Both are smoothed by as
many counts as ``SMOOTHING`` raw ones are in the target, but by no fewer than
``EVIDENCE`` target counts, so that a bucket of which the target tells too
little has a ratio of 1 and documents outside the target are not held against
it. A target of up to ``EVIDENCE / SMOOTHING`` of the corpus is thus smoothed
alike in a corpus of any size. A document at or above ``THRESHOLD`` is kept.
The raw counts cover every document. The target is fitted on at most ``TARGET_ROWS`` trusted ids
(those of smallest hash), so that the ids can be broadcast and no text has to
be shuffled to find its label; the driver gets the ``BUCKETS`` counts.

A few abusive words do not show in a mean, so toxicity has a ratio of its own:
words (by hash) are counted by distinct documents, in those labelled toxic and
in trusted ones. Words that the toxic ones have more of with ``TOXIC_EVIDENCE``
nats of log-likelihood make the lexicon. A document's toxicity is the Poisson
log-likelihood ratio of its distinct words over the lexicon; from ``TOXIC``
nats on it is marked, apart from the verdict on its quality. Both sides are
fitted on at most ``TARGET_ROWS`` documents, and the lexicon holds every such
word of theirs, so it is bounded by that parameter too.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import write_once

BUCKETS = 1 << 14
SMOOTHING = 40                 # raw counts per bucket
EVIDENCE = 12                  # target counts per bucket, at least
THRESHOLD = -0.05              # nats per n-gram
TARGET_ROWS = 50_000
TOXIC = 4.0                    # nats per document
TOXIC_EVIDENCE = 8.0           # nats per word
MIN_WORDS = 50
REPEAT_PERCENT = 50
WORD = r"[^\x20\x09-\x0D]+"


# ------------------------------------------------------------- expressions
def words(text: str = "text") -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def ngram_buckets(hashes: str, buckets: int) -> Column:
    """Buckets of the words, then of the pairs of neighbouring words."""
    return F.expr(f"""concat(
        transform({hashes}, h -> cast(pmod(h, {buckets}L) as int)),
        transform(slice({hashes}, 1, greatest(size({hashes}) - 1, 0)),
                  (h, i) -> cast(pmod(xxhash64(h, get({hashes}, i + 1)), {buckets}L) as int)))""")


def with_words(docs: DataFrame) -> DataFrame:
    """``_words`` and their hashes ``_hashes`` beside the columns of docs."""
    return (docs.withColumn("_words", words())
            .withColumn("_hashes", F.expr("transform(_words, w -> xxhash64(w))")))


def base_rules(worded: DataFrame) -> DataFrame:
    """``_n_words, _word_chars, _n_symbols, _n_dup_lines, _n_repeat_words``.

    Repeated words: the hashes of the 3-word windows are sorted with their
    positions, so equal windows are neighbours; each repeated window covers
    three words, less what the next one covers too.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    out = worded.withColumns({
        "_n_words": F.size("_words").cast("long"),
        "_word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "_n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "_lines": F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        "_windows": F.expr("transform(slice(_hashes, 1, greatest(size(_hashes) - 2, 0)), "
                           "(h, i) -> xxhash64(h, get(_hashes, i + 1), get(_hashes, i + 2)))"),
    })
    out = out.withColumn("_n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    out = out.withColumn("_sorted", F.expr(
        "if(size(array_distinct(_windows)) = size(_windows), null, "
        "sort_array(transform(_windows, (h, i) -> struct(h as h, i as i))))"))
    out = out.withColumn("_at", F.expr(
        "sort_array(transform(filter(_sorted, (x, k) -> x.h <=> get(_sorted, k - 1).h "
        "or x.h <=> get(_sorted, k + 1).h), x -> x.i))"))
    covered = F.expr("aggregate(transform(_at, (p, k) -> least(3, coalesce(get(_at, k + 1) - p, 3))), "
                     "0L, (a, n) -> a + n)")
    return (out.withColumn("_n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
            .drop("_lines", "_windows", "_sorted", "_at"))


# ------------------------------------------------------------------- model
def trusted_ids(labels: DataFrame, target_rows: int = TARGET_ROWS, toxic: int = 0) -> DataFrame:
    """Ids of documents labelled good and not toxic (or good and ``toxic``); of
    more than ``target_rows`` those with the smallest hashes."""
    return (labels.where(f"quality = 1 AND toxic = {toxic} AND doc_id IS NOT NULL").select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
        target_rows: int = TARGET_ROWS) -> list[float]:
    """The log ratio of every bucket. Without a trusted document all are 0."""
    # at most target_rows ids: safe to broadcast
    trusted = F.broadcast(trusted_ids(labels, target_rows).withColumn("_trusted", F.lit(1)))
    marked = docs.select("doc_id", "text").join(trusted, "doc_id", "left")
    grams = (with_words(marked).select("_trusted", F.explode(ngram_buckets("_hashes", buckets)).alias("bucket")))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("_trusted").alias("target")).collect()
    raw, target = [0] * buckets, [0] * buckets
    for row in counts:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not any(target):
        return [0.0] * buckets
    part = sum(target) / sum(raw)
    extra = max(SMOOTHING * part, EVIDENCE)
    return [math.log((t + extra) / (r * part + extra)) for r, t in zip(raw, target)]


def toxic_words(docs: DataFrame, labels: DataFrame,
                target_rows: int = TARGET_ROWS) -> tuple[list[tuple[int, float]], float]:
    """The lexicon as ``(hash, log ratio)``, and what a document loses for each
    of its distinct words: the difference of the lexicon's rates. Without a
    toxic or a trusted document it is empty."""
    clean = trusted_ids(labels, target_rows).withColumn("_toxic", F.lit(0))
    toxic = trusted_ids(labels, target_rows, 1).withColumn("_toxic", F.lit(1))
    # at most twice target_rows ids: safe to broadcast
    marked = docs.select("doc_id", "text").join(F.broadcast(clean.unionAll(toxic)), "doc_id")
    counts = write_once(with_words(marked).select("_toxic", F.explode(F.array_distinct("_hashes")).alias("word"))
                        .groupBy("word").agg(F.sum("_toxic").alias("k"), F.sum(1 - F.col("_toxic")).alias("o")),
                        "toxic-words")
    all_k, all_o = counts.agg(F.sum("k"), F.sum("o")).first()
    if not all_k or not all_o:
        return [], 0.0
    part = all_k / (all_k + all_o)
    evidence = F.expr(f"""k * ln(k / ((k + o) * {part!r}D))
        + if(o > 0, o * ln(o / ((k + o) * {1 - part!r}D)), 0D)""")
    found = (counts.where(f"k >= 3 AND k > (k + o) * {part!r}D").withColumn("evidence", evidence)
             .where(F.col("evidence") >= TOXIC_EVIDENCE).orderBy(F.desc("evidence"), "word").collect())
    rates = [(r["word"], r["k"] / all_k, (r["o"] + 0.5) / all_o) for r in found]
    return [(w, math.log(a / b)) for w, a, b in rates], sum(a - b for _, a, b in rates)


def toxicity(words: list[tuple[int, float]], loss: float) -> Column:
    """Of a row with ``_hashes``."""
    if not words:
        return F.lit(0.0)
    hashes, ratios = (F.split(F.lit(",".join(map(repr, x))), ",") for x in zip(*words))
    hashes, ratios = hashes.cast("array<bigint>"), ratios.cast("array<double>")
    # a set of literals: looked up once per word, however many it has
    known = ", ".join(f"{w}L" for w, _ in words)
    hits = F.expr(f"filter(array_distinct(_hashes), h -> h IN ({known}))")
    total = F.aggregate(hits, F.lit(0.0), lambda a, h: a + F.get(ratios, (F.array_position(hashes, h) - 1).cast("int")))
    return F.when(F.size(hits) > 0, total - loss * F.size(F.array_distinct("_hashes"))).otherwise(0.0)


def scored(docs: DataFrame, ratios: list[float], toxic: tuple[list, float] = ([], 0.0)) -> DataFrame:
    """Base counts, ``_score`` and ``_toxicity`` beside the columns of docs. A
    text without words scores 0."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    buckets = len(ratios)
    ruled = base_rules(with_words(docs)).withColumn("_grams", ngram_buckets("_hashes", buckets))
    total = F.aggregate("_grams", F.lit(0.0), lambda a, b: a + F.get(table, b))
    return (ruled.withColumn("_score", F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(0.0))
            .withColumn("_toxicity", toxicity(*toxic))
            .drop("_words", "_hashes", "_grams"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of docs with the counts, ``_score``, ``_toxicity``,
    ``_base_failed``, ``_toxic`` and ``_kept`` (the quality alone) for every row."""
    failed = (F.col("_n_words") < MIN_WORDS) | (100 * F.col("_n_repeat_words") > REPEAT_PERCENT * F.col("_n_words"))
    ruled = (scored(docs, fit(docs, labels), toxic_words(docs, labels)).withColumn("_base_failed", failed)
             .withColumn("_toxic", F.col("_toxicity") >= TOXIC)
             .withColumn("_kept", ~F.col("_base_failed") & (F.col("_score") >= threshold)))
    found = [c for c in ruled.columns if c not in docs.columns]
    # a generator of one row: else a filter on the verdict would be pushed into
    # the expressions above, and each of them computed again for every use
    return ruled.select(*docs.columns, F.inline(F.array(F.struct(*found))))
