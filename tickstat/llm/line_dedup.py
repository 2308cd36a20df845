"""Line dedup by pairwise alignment of overlapping documents.

A *run* is the shortest stretch of consecutive lines, from a given line on or
up to it, that has at least ``min_words`` words. Any block of common lines with
that many words is covered by such runs, the same in both documents, so
documents overlap exactly where they share run hashes; runs are long enough to
be rare by nature, and no frequency cap is needed. Every later
document with a run is paired with the first document that has it (a star,
not all pairs); each pair is aligned with patience diff over the documents'
line hashes, and the aligned common blocks of at least ``min_words`` words go
from the later document. Blocks that the alignment cannot keep in order
(moved or repeated ones) are matched from the shared runs left over.

The result: a line goes exactly when it lies in a stretch of at least
``min_words`` words that an earlier document has too. The first document of
all keeps every passage.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, write_once

MIN_WORDS = 20


# ------------------------------------------------------ lines and alignment
def line_table(text: str | None) -> tuple[list[int], list[int], list[int]]:
    """Positions, hashes and word counts of the lines with a word; white
    space around a line does not count."""
    import xxhash

    at, hashes, words = [], [], []
    for i, line in enumerate((text or "").encode().split(b"\n")):
        line = line.strip()
        if line:
            at.append(i)
            hashes.append(xxhash.xxh3_64_intdigest(line) - (1 << 63))
            words.append(len(line.split()))
    return at, hashes, words


def _ends(words: list[int], min_words: int) -> list[int]:
    """End (exclusive) of the run from each line, as far as one begins there."""
    out, end, total = [], 0, 0
    for start in range(len(words)):
        while total < min_words and end < len(words):
            total += words[end]
            end += 1
        if total < min_words:
            break
        out.append(end)
        total -= words[start]
    return out


def runs_of(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """All runs: the shortest from each line on, and the shortest up to it."""
    n = len(words)
    runs = set(enumerate(_ends(words, min_words)))
    runs.update((n - e, n - s) for s, e in enumerate(_ends(words[::-1], min_words)))
    return sorted(runs)


def run_hashes(hashes: list[int], words: list[int], min_words: int) -> list[int]:
    import struct

    import xxhash

    packed = struct.pack(f"<{len(hashes)}q", *hashes)
    return [xxhash.xxh3_64_intdigest(packed[8 * s:8 * e]) - (1 << 63)
            for s, e in runs_of(words, min_words)]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff: pairs of equal lines in order. Lines unique on both
    sides are threaded by the longest increasing subsequence; equal lines
    next to a matched one are matched too; gaps are worked on in turn."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            pairs.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            pairs.append((ahi, bhi))
        once_a: dict[int, int] = {}
        for i in range(alo, ahi):
            once_a[a[i]] = -1 if a[i] in once_a else i
        once_b: dict[int, int] = {}
        for j in range(blo, bhi):
            if b[j] in once_a:
                once_b[b[j]] = -1 if b[j] in once_b else j
        unique = [(once_a[h], j) for h, j in once_b.items() if j >= 0 and once_a[h] >= 0]
        unique.sort(key=lambda p: p[1])
        tails: list[int] = []                  # smallest last a of a thread of each length
        last: list[int] = []
        back = [-1] * len(unique)
        for k, (i, _) in enumerate(unique):
            length = bisect_left(tails, i)
            back[k] = last[length - 1] if length else -1
            tails[length:length + 1] = [i]
            last[length:length + 1] = [k]
        k = last[-1] if last else -1
        thread = []
        while k >= 0:
            thread.append(unique[k])
            k = back[k]
        if thread:
            pairs += thread
            edges = [(alo - 1, blo - 1), *thread[::-1], (ahi, bhi)]
            todo += [(p[0] + 1, q[0], p[1] + 1, q[1]) for p, q in zip(edges, edges[1:])
                     if p[0] + 1 < q[0] and p[1] + 1 < q[1]]
    return sorted(pairs, key=lambda p: p[1])


def common_lines(a: list[int], b: list[int], b_words: list[int], min_words: int) -> set[int]:
    """Lines of ``b`` in blocks of ``min_words`` words or more common with ``a``."""
    out: set[int] = set()
    block: list[int] = []
    before = None
    for i, j in [*patience(a, b), (-9, -9)]:
        if before != (i - 1, j - 1):
            if sum(b_words[k] for k in block) >= min_words:
                out.update(block)
            block = []
        block.append(j)
        before = (i, j)
    # shared runs that are not covered: moved, or more often in one than in the other
    left = [(s, e) for s, e in runs_of(b_words, min_words) if any(k not in out for k in range(s, e))]
    windows = {n: stretches(a, n) for n in {e - s for s, e in left}}
    for s, e in left:
        if tuple(b[s:e]) in windows[e - s]:
            out.update(range(s, e))
    return out


class stretches:     # noqa: N801 - a set
    """The stretches of ``n`` neighbours in a list, found by hash and compared:
    linear in the list, whatever repeats in it."""

    BASE, PRIME = 0x9E3779B97F4A7C15, (1 << 61) - 1

    def __init__(self, values: list[int], n: int):
        self.values, self.n, self.at = values, n, {}
        lead, h = pow(self.BASE, n - 1, self.PRIME), 0
        for i, v in enumerate(values):
            if i >= n:
                h = (h - values[i - n] * lead) % self.PRIME
            h = (h * self.BASE + v) % self.PRIME
            if i >= n - 1:
                self.at.setdefault(h, i - n + 1)

    def __contains__(self, run: tuple) -> bool:
        h = 0
        for v in run:
            h = (h * self.BASE + v) % self.PRIME
        if h not in self.at:
            return False
        held, n = self.values, self.n
        start = self.at[h]
        # another stretch with the same hash as good as never comes first
        return tuple(held[start:start + n]) == run or any(
            tuple(held[i:i + n]) == run for i in range(len(held) - n + 1))


# ---------------------------------------------------------------- operator
def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            cols: list[list] = [[], [], []]
            for t in batch.column(2):
                _, hashes, words = line_table(t.as_py())
                for col, value in zip(cols, (hashes, words, run_hashes(hashes, words, min_words))):
                    col.append(value)
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.record_batch([batch.column(0), batch.column(1),
                                   *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                  ["key", "doc_id", "hashes", "words", "runs"])

    src = docs.select(row_key().alias("key"), "doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"key string, doc_id {kind}, hashes array<long>, words array<int>, runs array<long>")
    return write_once(out, "lines")


def overlapping(lines: DataFrame) -> DataFrame:
    """``(first, first_id, key)``: every document that shares a run with an
    earlier one, beside the first document with that run. Order: ids, NULL
    ids last, equal ids by key. Partial minima and maxima travel, not groups."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    runs = lines.select(place.alias("place"), F.explode("runs").alias("run"))
    ends = runs.groupBy("run").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    shared = ends.where("first.key <> last.key").select("run", "first")
    return (runs.join(shared, "run").where("place.key <> first.key")
            .select(F.col("first.key").alias("first"), F.col("first.doc_id").alias("first_id"),
                    F.col("place.key").alias("key")).distinct())


def removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(key, lines, partners)``: positions, among a document's lines with a
    word, of those that go, and the ids of the documents it shares them with."""
    lines = _lines(docs, min_words)
    pairs = (overlapping(lines)
             .join(lines.select(F.col("key").alias("first"), F.col("hashes").alias("a")), "first")
             .join(lines.select("key", F.col("hashes").alias("b"), "words"), "key"))

    def align(batches):
        for batch in batches:
            gone = []
            for a, b, w in zip(batch.column(2), batch.column(3), batch.column(4)):
                gone.append(sorted(common_lines(a.as_py(), b.as_py(), w.as_py(), min_words)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))],
                                  ["key", "first_id", "gone"])

    src = pairs.select("key", "first_id", "a", "b", "words")
    kind = src.schema["first_id"].dataType.simpleString()
    aligned = src.mapInArrow(align, f"key string, first_id {kind}, gone array<int>")
    return (aligned.where(F.size("gone") > 0).select("key", "first_id", F.explode("gone").alias("line"))
            .groupBy("key").agg(F.sort_array(F.collect_set("line")).alias("lines"),
                                F.sort_array(F.collect_set("first_id")).alias("partners")))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with ``text`` less its removed lines, and
    ``_n_lines`` (lines with a word), ``_n_removed``, ``_partners`` (ids it
    shares them with) beside them. Lines without a word stay. A NULL text
    stays NULL; repeated rows (same id and text) count as one document."""
    found = removals(docs, min_words)
    keyed = docs.withColumn("_key", row_key())
    joined = keyed.join(found.select(F.col("key").alias("_key"), F.col("lines").alias("_lines"),
                                     F.col("partners").alias("_partners")), "_key", "left").drop("_key")

    def strip(batches):
        for batch in batches:
            text_at, lines_at = batch.schema.get_field_index("text"), batch.schema.get_field_index("_lines")
            texts, counts = [], []
            for t, gone in zip(batch.column(text_at), batch.column(lines_at)):
                text, gone = t.as_py(), set(gone.as_py() or ())
                parts = (text or "").split("\n")
                worded = [i for i, part in enumerate(parts) if part.encode().strip()]
                counts.append(len(worded))
                if gone:
                    drop = {worded[k] for k in gone}
                    text = "\n".join(part for i, part in enumerate(parts) if i not in drop)
                texts.append(text)
            out = batch.set_column(text_at, "text", pa.array(texts, batch.schema.field(text_at).type))
            yield out.append_column("_n_lines", pa.array(counts, pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema) + ", _n_lines long"
    return (joined.mapInArrow(strip, schema)
            .withColumn("_n_removed", F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("long"))
            .drop("_lines"))
