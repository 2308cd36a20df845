"""Mixing sources to target weights in blocks of tokens.

1. Packing: the documents of a source follow one another in a pseudorandom
   order; every ``block_words`` words of that stream are a block. Positions
   are running sums in two levels (within slices of the order, and over the
   slices' totals), so a source of any size is spread over many tasks.
2. Targets: the driver shares the total over the sources by weight; a source
   stops at ``max_repeats`` times its size and the excess is shared again.
   A source gets as many slots as blocks make up its target.
3. Draws: the slots of the mix go through a seeded permutation of all slots,
   where every source owns an interval as long as its slots. A shard's slots
   fall into the intervals as balls drawn without replacement, so its source
   counts are a multinomial draw conditioned on the sources' slots being used
   up exactly; and where in the interval a slot falls tells which of the
   source's slots it is. A shard finds its draw alone, at any size.
4. A source's j-th slot is block ``j mod blocks`` of its ``j div blocks``-th
   pass, sent through a seeded Feistel permutation of the block numbers; so a
   block is used once more than another at most.
5. Slots and blocks are joined by (source, block number).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, write_once

BLOCK_WORDS = 32
SHARD_SLOTS = 4096
MAX_REPEATS = 3
MAX_SOURCES = 100_000            # a mix is configured per source on the driver
SLICE_DOCS = 5_000               # documents whose running sum is one task's
SEED = 8


# ---------------------------------------------------------------- targets
def cycle_weights(n: int) -> list[float]:
    return [(5.0, 2.0, 1.0)[i % 3] for i in range(n)]


def share_out(sizes: list[int], weights: list[float], max_repeats: int) -> list[float]:
    """Targets that add up to the total size: shares by weight, none above
    ``max_repeats`` times its size, the excess shared by weight again."""
    out, left, free = [0.0] * len(sizes), float(sum(sizes)), list(range(len(sizes)))
    while free:
        weight = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / weight > max_repeats * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = float(max_repeats * sizes[i])
        left -= sum(out[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return out


# ------------------------------------------------------------------ draws
def shard_draw(shard: int, quotas: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The source of every slot of a shard, and which of the source's slots it is."""
    ends = np.cumsum(quotas)
    slots = int(ends[-1])
    own = np.arange(shard * SHARD_SLOTS, min((shard + 1) * SHARD_SLOTS, slots))
    place = permute(own, slots, seed)
    source = np.searchsorted(ends, place, "right")
    return source, place - (ends - quotas)[source]


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1: four Feistel rounds over the least
    even number of bits, repeated until a value falls below n."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, out = np.uint64((1 << half) - 1), index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(4):
            salt = np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            h = (right + salt) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((h >> np.uint64(32)) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


# ---------------------------------------------------------------- operator
def measured(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(row, doc_id, source, size, place)`` of every row, written once:
    ``row`` numbers the rows of the written table, ``place`` is a hash of id
    and text that orders a source's documents the same way in every run.
    ``id_column`` is only handed through, as ``doc_id``."""
    def count(batches):
        for batch in batches:
            sizes = [len((t.as_py() or "").encode().split()) for t in batch.column(3)]
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64())],
                                  ["doc_id", "source", "place", "size"])

    src = docs.select(F.col(id_column).alias("doc_id"), F.col("source").cast("string").alias("source"),
                      F.xxhash64(row_key()).alias("place"), "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    sized = src.mapInArrow(count, f"doc_id {kind}, source string, place long, size long")
    return write_once(sized.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def source_targets(sized: DataFrame, weights=cycle_weights, max_repeats: int = MAX_REPEATS,
                   max_sources: int = MAX_SOURCES) -> list[tuple]:
    """``(number, source, size, target)`` by code point, NULL last. A mix of
    more than ``max_sources`` sources is refused, not cut."""
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources; pass max_sources to allow them")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    targets = share_out(sizes, weights(len(sizes)), max_repeats)
    return [(i, r["source"], r["size"], t) for i, (r, t) in enumerate(zip(found, targets))]


def block_parts(sized: DataFrame, numbered: DataFrame, block_words: int) -> DataFrame:
    """``(number, block, row, words)``: which words of a block a row holds."""
    slices = max(0, (sized.count() // SLICE_DOCS).bit_length())
    part = F.shiftrightunsigned("place", 64 - slices) if slices else F.lit(0)
    placed = (sized.where("size > 0").join(numbered, sized["source"].eqNullSafe(numbered["source"]))
              .select("number", "row", "place", "size", part.alias("part")))
    sums = placed.groupBy("number", "part").agg(F.sum("size").alias("total"))
    ahead = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("number", "part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base"))
    inner = (Window.partitionBy("number", "part").orderBy("place", "row")
             .rowsBetween(Window.unboundedPreceding, -1))
    at = placed.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    at = at.join(starts, ["number", "part"]).withColumn("start", F.col("base") + F.col("inner"))
    stop = F.col("start") + F.col("size")
    first, last = F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")
    parts = at.select("number", "row", "start", stop.alias("stop"), F.explode(F.sequence(first, last)).alias("block"))
    words = (F.least("stop", (F.col("block") + 1) * block_words)
             - F.greatest("start", F.col("block") * block_words))
    return parts.select("number", "block", "row", words.alias("words"))


def slot_plan(spark, targets: list[tuple], block_words: int, max_repeats: int, seed: int) -> DataFrame:
    """``(shard, slot, number, block)``: the block behind every slot of the mix."""
    sizes = np.array([s for _, _, s, _ in targets], np.int64)
    blocks = -(-sizes // block_words)
    quotas = np.array([min(round(t / s * b), max_repeats * b) if s else 0
                       for (_, _, s, t), b in zip(targets, blocks.tolist())], np.int64)
    slots = int(quotas.sum())
    shards = -(-slots // SHARD_SLOTS)

    def run(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                number, j = shard_draw(shard, quotas, seed)
                turn, index = j // blocks[number], j % blocks[number]
                block = np.empty(len(j), np.int64)
                order = np.lexsort((turn, number))             # the slots of a source and pass together
                for own in np.split(order, np.flatnonzero(np.diff(number[order]) | np.diff(turn[order])) + 1):
                    s, t = int(number[own[0]]), int(turn[own[0]])
                    block[own] = permute(index[own], int(blocks[s]), (seed * 1_000_003 + s) * 1_009 + t)
                yield pa.record_batch([pa.array(np.full(len(j), shard)), pa.array(np.arange(len(j))),
                                       pa.array(number.astype(np.int32)), pa.array(block)],
                                      ["shard", "slot", "number", "block"])

    return spark.range(0, shards).mapInArrow(run, "shard long, slot long, number int, block long")


def mix(docs: DataFrame, weights=cycle_weights, block_words: int = BLOCK_WORDS,
        max_repeats: int = MAX_REPEATS, max_sources: int = MAX_SOURCES, seed: int = SEED,
        id_column: str = "doc_id") -> dict:
    """The mix of all rows: ``documents`` ``(row, doc_id, source, place, size,
    source_size, target, taken)``, one per input row; ``plan`` (see
    ``slot_plan``); ``parts`` (see ``block_parts``). A document without words
    has nothing to take; repeated rows are separate documents."""
    spark = docs.sparkSession
    sized = measured(docs, id_column)
    targets = source_targets(sized, weights, max_repeats, max_sources)
    # at most max_sources rows, checked above: safe to broadcast
    numbered = F.broadcast(spark.createDataFrame(targets, "number int, source string, source_size long, target double"))
    parts = block_parts(sized, numbered, block_words)
    plan = slot_plan(spark, targets, block_words, max_repeats, seed)
    # the plan comes out of a few shard numbers, so its estimated size is far too
    # small: it grows with the corpus and must not be broadcast
    taken = (plan.hint("merge").join(parts, ["number", "block"])
             .groupBy("row").agg(F.sum("words").alias("taken")))
    named = sized.join(numbered, sized["source"].eqNullSafe(numbered["source"])).drop(numbered["source"])
    documents = (named.join(taken, "row", "left")
                 .select("row", "doc_id", "source", "place", "size", "source_size", "target",
                         F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))
    return {"documents": documents, "plan": plan, "parts": parts}
