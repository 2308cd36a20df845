"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: 64-bit SimHash over word shingles, each hashed with XXH64.

Search: the 64 bits are grouped into partitions, correlated bits together. By
the generalised pigeonhole principle, if thresholds t_i >= -1 add up to
``max_bits - partitions + 1``, two fingerprints within ``max_bits`` bits
differ by at most t_i bits in some partition i (-1: not probed). Dynamic
programming over partitions picks the thresholds that cost least: the
keys probed plus the candidates expected from the bits' agreement rates.
Each distinct fingerprint probes every key within t_i flips of its part,
and candidates are verified on all 64 bits.

Dense buckets: a bucket of more than ``bucket`` fingerprints (near-copies in
their thousands) is not paired up. Its members are joined through the points
halfway between them: two fingerprints are within 2r bits exactly when some
64-bit value is within r bits of both, so all members around a value are
linked to the smallest of them. That is linear in the bucket and loses no link.

Only distinct fingerprints are searched; copies of a text meet in a grouping.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, write_once

BITS = 64
SEED = 42
PART = 50_000          # shingles whose bits are counted at once


# ----------------------------------------------------------- fingerprints
def fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of a whole text; 0 without words."""
    import xxhash

    words = (text or "").encode().lower().split()      # bytes: A-Z only, ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        words, width = [b" ".join(words)], 1
    else:
        width = shingle
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(end[:-1] + 1).tolist()][:len(words) - width + 1]
    ends = end[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), PART):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[at:at + PART], ends[at:at + PART])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp long)`` for every row."""
    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp long")


# -------------------------------------------------------------- partitions
def bit_pairs(reps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for every pair of bits, how many have both
    set: partial 64 x 64 sums per task, 4,096 numbers to the driver."""
    def run(batches):
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            fps = np.asarray(batch.column(0)).astype("<i8")
            for at in range(0, len(fps), PART):
                part = np.ascontiguousarray(fps[at:at + PART]).view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(part, axis=1, bitorder="little").astype(np.float32)
                both += bits.T @ bits
                n += len(bits)
        cells = np.concatenate([[n], both.ravel()]).astype(np.int64)
        yield pa.record_batch([pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells)], ["cell", "n"])

    rows = reps.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(1 + BITS * BITS, np.int64)
    for row in rows.collect():
        flat[row["cell"]] = row["n"]
    return int(flat[0]), flat[1:].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Equal groups of bits; a group starts at the bit most correlated with
    the rest and takes the bits most correlated with what it has."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    left, groups = list(range(BITS)), []
    for k in range(parts, 0, -1):
        size = len(left) // k
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(max(rest, key=lambda b: (corr[b, group].sum(), -b)))
        left = [b for b in left if b not in group]
        groups.append(sorted(group))
    return groups


def within(agree: list[float]) -> np.ndarray:
    """Probability that two fingerprints differ in at most t of these bits."""
    ways = np.array([1.0])
    for q in agree:
        ways = np.convolve(ways, [q, 1 - q])
    return np.cumsum(ways)


def choose_plan(n: int, both: np.ndarray, max_bits: int) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of every probed partition, at the least expected
    cost over all numbers of partitions and all splits of the threshold."""
    p = np.diag(both) / max(n, 1)
    agree = p * p + (1 - p) * (1 - p)
    best: tuple[float, list] = (np.inf, [])
    for parts in range(1, max_bits + 3):
        groups = group_bits(n, both, parts)
        total = max_bits + 1                     # sum of (threshold + 1)
        table: list[tuple[float, list[int]]] = [(0.0, [])] + [(np.inf, [])] * total
        for bits in groups:
            near, keys = within([agree[b] for b in bits]), 0
            cost = [0.0]
            for t in range(min(total, len(bits) + 1)):
                keys += len(list(combinations(bits, t))) if t else 1
                cost.append(n * keys + 0.5 * n * n * near[t])
            table = [min(((table[u - own][0] + cost[own], table[u - own][1] + [own - 1])
                          for own in range(min(u + 1, len(cost)))), key=lambda x: x[0])
                     for u in range(total + 1)]
        if table[total][0] < best[0]:
            best = (table[total][0], [(g, t) for g, t in zip(groups, table[total][1]) if t >= 0])
    return best[1]


# ------------------------------------------------------------------ search
def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _flips(bits: list[int], radius: int) -> list[int]:
    """Masks that flip up to ``radius`` of these bits."""
    return [_signed(sum(1 << b for b in some)) for r in range(radius + 1) for some in combinations(bits, r)]


def _xors(value: Column, masks: list[int]) -> Column:
    listed = F.array(*(F.lit(m).cast("long") for m in masks))
    return F.transform(listed, lambda m: value.bitwiseXOR(m))


def candidate_links(reps: DataFrame, plan: list[tuple[list[int], int]], max_bits: int,
                    bucket: int) -> DataFrame:
    """``(a, b)`` links between distinct fingerprints, all verified, with the
    same components as all pairs within ``max_bits``."""
    def keyed(radius_of) -> DataFrame:
        parts = [reps.select("fp", F.lit(i).alias("part"),
                             F.explode(_xors(F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))).cast("long")),
                                             _flips(bits, radius_of(t)))).alias("key"))
                 for i, (bits, t) in enumerate(plan)]
        return reduce(DataFrame.unionByName, parts)

    index, probes = keyed(lambda t: 0), keyed(lambda t: t)
    size = index.groupBy("part", "key").agg(F.count("*").alias("n"))
    shared = size.where("n > 1") if all(t == 0 for _, t in plan) else size
    cold, hot = shared.where(F.col("n") <= bucket), shared.where(F.col("n") > bucket)
    pairs = (probes.join(cold.select("part", "key"), ["part", "key"])
             .join(index.withColumnRenamed("fp", "other"), ["part", "key"])
             .where("fp < other")
             .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits)
             .select(F.col("fp").alias("a"), F.col("other").alias("b")))
    # every member of a dense bucket once, however many of its parts are dense
    dense = probes.join(hot.select("part", "key"), ["part", "key"]).select("fp").distinct()
    # an odd bound: values within r of one and r - 1 of the other
    radius, all_near = (max_bits + 1) // 2, max_bits % 2 == 0
    far = len(_flips(list(range(BITS)), radius - 1)) if not all_near else 0
    points = (dense.select("fp", F.posexplode(_xors(F.col("fp"), _flips(list(range(BITS)), radius))).alias("k", "point"))
              .withColumn("near", F.lit(all_near) | (F.col("k") < far)))
    centre = points.groupBy("point").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("a"),
                                         F.count("*").alias("n")).where("n > 1 AND a IS NOT NULL")
    stars = points.join(centre.drop("n"), "point").where("a <> fp").select("a", F.col("fp").alias("b")).distinct()
    return pairs.unionByName(stars)


def near_groups(fps: DataFrame, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """``(fp, first_id, group_id)`` for every distinct fingerprint: the
    smallest id with it, and the smallest id reachable over links of at most
    ``max_bits`` bits. NULL ids are no smallest ones; a group of NULL ids
    only has a NULL id."""
    reps = write_once(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-reps")
    n, both = bit_pairs(reps)
    links = candidate_links(reps, choose_plan(n, both, max_bits), max_bits, bucket)
    named = reps.join(components(links).withColumnRenamed("node", "fp"), "fp", "left")
    named = named.withColumn("root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("first_id").alias("group_id"))
    return named.join(lowest, "root").select("fp", "first_id", "group_id", "root")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, bucket: int = 64) -> DataFrame:
    """``(doc_id, fp, group_id, root)`` for every row; ``root`` names the
    group also where all its ids are NULL. Texts without words have the
    fingerprint 0 and are linked like any other."""
    fps = write_once(fingerprints(docs, shingle), "simhash")
    return fps.join(near_groups(fps, max_bits, bucket).select("fp", "group_id", "root"), "fp")
