"""Order-independent document fingerprints: a homomorphic multiset hash.

Every paragraph (a line with a character in it) hashes to a wide vector, a
document is the sum of its paragraphs' vectors, lane by lane modulo a power of
two. So paragraphs in another order give the same fingerprint, and inserting or
deleting a paragraph adds or subtracts its vector (``combine``) without the
rest of the text. The vector has two parts:

* ``STRONG`` lanes modulo 2**64 with the paragraph's BLAKE2b digest: equal
  sums stand for equal multisets of paragraphs;
* ``SKETCH`` lanes modulo 2**64 with a signed count of the paragraph's byte
  windows, whose cosine is the likeness of two documents; a paragraph shorter
  than a window is one window, padded. No count of a text reaches 2**63, so
  the lanes read back as signed numbers are exact.

The empty document is the zero vector.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRONG, SKETCH = 8, 128
WINDOW = 8                     # bytes, never across paragraphs
SLICE = 1 << 20                # windows hashed at once
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x100000001B3


def short_paragraphs(data: np.ndarray):
    """Window hashes, in slices, of the paragraphs of 1 to ``WINDOW - 1`` bytes,
    padded at the end with a value that no byte has."""
    ends = np.append(np.flatnonzero(data == 10), len(data))
    starts = np.append(0, ends[:-1] + 1)
    short = (ends > starts) & (ends - starts < WINDOW)
    starts, sizes = starts[short], (ends - starts)[short]
    for at in range(0, len(starts), SLICE):
        start, length = starts[at:at + SLICE], sizes[at:at + SLICE]
        h = np.zeros(len(start), np.uint64)
        for k in range(WINDOW):
            byte = data[np.minimum(start + k, len(data) - 1)].astype(np.uint64) + np.uint64(1)
            h = h * np.uint64(BASE) + np.where(k < length, byte, np.uint64(0))
        yield h


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The two parts of a whole text."""
    raw = text.encode()
    strong = np.zeros(STRONG, np.uint64)
    digests = [hashlib.blake2b(p, digest_size=8 * STRONG).digest() for p in raw.split(b"\n") if p]
    if digests:
        strong = np.frombuffer(b"".join(digests), "<u8").reshape(-1, STRONG).sum(axis=0, dtype=np.uint64)
    data = np.frombuffer(raw, np.uint8)
    counts = np.zeros(2 * SKETCH, np.int64)
    shift = np.uint64(64 - (2 * SKETCH - 1).bit_length())
    for at in range(0, len(data) - WINDOW + 1, SLICE):
        part = data[at:at + SLICE + WINDOW - 1]
        h, width = part.astype(np.uint64) + np.uint64(1), 1
        while width < WINDOW:                           # h covers 1, 2, 4, 8 bytes
            step = np.uint64(pow(BASE, width, 1 << 64))
            h, width = h[:-width] * step + h[width:], 2 * width
        ends = np.flatnonzero(part == 10)
        bins = ((h * MIX) >> shift).astype(np.int64)
        if len(ends):
            inside = np.ones(len(bins), bool)
            hit = (ends[:, None] - np.arange(WINDOW)).ravel()
            inside[hit[(hit >= 0) & (hit < len(bins))]] = False
            bins = bins[inside]
        counts += np.bincount(bins, minlength=2 * SKETCH)
    for h in short_paragraphs(data):
        counts += np.bincount(((h * MIX) >> shift).astype(np.int64), minlength=2 * SKETCH)
    sketch = (counts[0::2] - counts[1::2]).astype(np.uint64)      # modulo 2**64
    return strong, sketch


def to_string(strong: np.ndarray, sketch: np.ndarray) -> str:
    return base64.b64encode(strong.astype("<u8").tobytes() + sketch.astype("<u8").tobytes()).decode()


def from_string(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[:8 * STRONG], "<u8"), np.frombuffer(raw[8 * STRONG:], "<u8")


def combine(a: str, b: str, sign: int = 1) -> str:
    """Fingerprint of both documents' paragraphs together (sign 1), or of a's
    without b's (sign -1)."""
    (a1, a2), (b1, b2) = from_string(a), from_string(b)
    return to_string(a1 + b1, a2 + b2) if sign > 0 else to_string(a1 - b1, a2 - b2)


def likeness(a: tuple, b: tuple) -> float:
    """1 for equal fingerprints, else the cosine of the sketches, at least 0."""
    if (a[0] == b[0]).all() and (a[1] == b[1]).all():
        return 1.0
    x, y = a[1].astype(np.int64).astype(float), b[1].astype(np.int64).astype(float)
    norm = float(np.sqrt(x @ x) * np.sqrt(y @ y))
    return min(1.0, max(0.0, float(x @ y) / norm)) if norm else 0.0


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row."""
    def run(batches):
        for batch in batches:
            out = [to_string(*vector(t.as_py() or "")) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], ["doc_id", "fingerprint"])

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fingerprint string")


# --------------------------------------------------- neighbours in id order
def followed(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every row with its successor next to it, for a pass in order.

    Ids are integers (other types end the query with a cast error).
    Rows are dealt to id ranges; the first row of each range is also sent to
    the range before it as its ``tail`` (the very first row to the last
    range), so that no task needs another one's rows. Returns ``(bucket, tail,
    doc_id, tie, text)`` sorted within partitions; inside a bucket each row's
    successor is the next row. Order: ids ascending, NULL ids last, equal ids
    by the MD5 of the text.

    The driver gets ``ranges`` cut points (quantiles of the ids) and one
    smallest id per range, whatever the number of rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = [i / ranges for i in range(1, ranges)]
    ids = rows.select("doc_id")
    found = ids.agg(F.count("doc_id").alias("ids"), F.count("*").alias("rows"),
                    F.percentile_approx("doc_id", share or [0.5], 20 * ranges + 1000).alias("cuts")).first()
    cuts = np.unique(np.array(found["cuts"] if share and found["cuts"] else [], np.int64))
    none = len(cuts) + 1                                   # the bucket of NULL ids

    def bucket_of(column: pa.Array) -> np.ndarray:
        values = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.where(column.is_null().to_numpy(zero_copy_only=False), none,
                        np.searchsorted(cuts, values, "right"))

    def lowest(batches):
        for batch in batches:
            yield pa.record_batch([pa.array(bucket_of(batch.column(0)), pa.int32()), batch.column(0)],
                                  ["bucket", "doc_id"])

    kind = ids.schema["doc_id"].dataType.simpleString()
    smallest = {r["bucket"]: r["low"] for r in
                ids.where("doc_id IS NOT NULL").mapInArrow(lowest, f"bucket int, doc_id {kind}")
                .groupBy("bucket").agg(F.min("doc_id").alias("low")).collect()}
    first_tie = None
    if found["rows"] > found["ids"]:
        first_tie = rows.where("doc_id IS NULL").agg(F.min(F.md5(F.coalesce("text", F.lit(""))))).first()[0]
        smallest[none] = None
    order = sorted(smallest)
    before = {order[i]: order[i - 1] for i in range(len(order))}     # the first's is the last

    def deal(batches):
        for batch in batches:
            doc_id, tie = batch.column(0), batch.column(2)
            bucket = bucket_of(doc_id)
            take, to, tail = list(range(len(bucket))), bucket.tolist(), [False] * len(bucket)
            for k, (b, i, t) in enumerate(zip(bucket.tolist(), doc_id.to_pylist(), tie.to_pylist())):
                if i == smallest[b] and (i is not None or t == first_tie):
                    take.append(k)
                    to.append(before[b])
                    tail.append(True)
            rows_of = batch.take(pa.array(take, pa.int64()))
            yield pa.record_batch([pa.array(to, pa.int32()), pa.array(tail), rows_of.column(0),
                                   rows_of.column(2), rows_of.column(1)],
                                  ["bucket", "tail", "doc_id", "tie", "text"])

    dealt = (rows.withColumn("tie", F.md5(F.coalesce("text", F.lit(""))))
             .mapInArrow(deal, f"bucket int, tail boolean, doc_id {kind}, tie string, text string"))
    return (dealt.repartition(ranges, "bucket")
            .sortWithinPartitions("bucket", "tail", F.col("doc_id").asc_nulls_last(), "tie"))


def with_edited(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every row's fingerprint beside that of its edited text and of the next
    document: ``(doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next)``. The edited text has the
    last quarter of its characters replaced by as many first ones of the next
    document (by all if it has fewer)."""
    rows = followed(docs, ranges)
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        held = None                                        # bucket, tail, doc_id, text, vector
        for batch in batches:
            out: list[tuple] = []
            buckets, tails = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ids, texts = batch.column(2).to_pylist(), batch.column(4)
            for k, bucket in enumerate(buckets):
                text = texts[k].as_py() or ""
                if held and held[0] == bucket and held[1]:
                    continue                               # a further tail of equal id
                now = vector(text)
                if held and held[0] == bucket:
                    _, _, doc_id, old, own = held
                    cut = len(old) // 4
                    edited = old[:len(old) - cut] + text[:cut]
                    changed = vector(edited)
                    out.append((doc_id, len(old), hashlib.sha256(edited.encode()).hexdigest(),
                                to_string(*own), to_string(*changed), likeness(own, changed),
                                likeness(own, now)))
                held = (bucket, tails[k], ids[k], text, now)
            kinds = [batch.schema.field(2).type, pa.int64(), pa.string(), pa.string(), pa.string(),
                     pa.float64(), pa.float64()]
            yield pa.record_batch([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)], names)

    return rows.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")
