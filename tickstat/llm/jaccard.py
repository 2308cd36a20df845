"""Jaccard join over sets of word shingles, by parity sketches.

A shingle is XORed into its set's parity sketch, so two sketches differ in at
most as many places as the sets have shingles that only one of them holds.
Sets of n and m shingles are linked at ``percent`` exactly when that number is
at most (n + m) (100 - percent) / (100 + percent).

Pigeonhole join, per size band: a band is a range of sizes (a power of two to
the next) with one number of sketch words. A word is the XOR of the hashes of
the shingles that fall to it. Of two linked sets at most d words can differ, d
being the bound above. Take a set's words that are not zero, in any order that
is the same for all sets: in front of the first word that two sets share, all
words of either differ from the other's, so it is among the first d + 1 of
both, and those are the set's keys. Sets that share no word have at most d
words that are not zero; such a set also lists its shingles, and two of them
meet there in the same way. A set joins the band of every size its partners
can have, so each pair meets in the band of the larger. A second sketch, of
bits, whose Hamming distance is a lower bound too, sorts out most candidates.

Keys that several sets share are written down. Every key first compares its
sets with one of them, then, where they are in several components, with one
of the component that has most of them; that joins near-copies in their
thousands. Only keys whose sets are then still in several components go on:
up to ``BUCKET`` sets are compared across components, by a join whose condition
is the distance of sketches folded to 256 bits, then of whole ones. The sets of larger keys (a passage that many texts
share makes such keys) are searched again with those keys at the end of the
order, so that they are keys only of sets that have little else; what shares
even these without being connected is compared in full. Every candidate is
verified on the shingles themselves, which are taken from the texts again, so
no link between components is lost.

Filters spare work and decide nothing: of the rows with equal sets only one
lists its keys, of the keys only those that may be shared are dealt out, of the
texts only those that may be candidates are hashed again. They have
``FILTER_BITS`` bits; those of rows and of shared keys grow with what they hold
up to ``MOST_FILTER_BITS``. Far more values than bits let everything through.

Defined results: NULL, empty and blank texts have no shingles and no links.
Repeated rows and copies are one set. A NULL id is no smallest id; where all
ids of a component are NULL, so is its id. Shingles and sets are told apart by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, write_once

BUCKET = 64                           # sets of a key that are compared with each other
DENSITY = 0.27                        # words of a band's sketch per shingle of its largest set
SKETCH = 1024                         # least bits of the sketch that sorts out candidates
FILTER_BITS, MOST_FILTER_BITS = 25, 28   # of the filters in front of keys and texts, 4 to 32 MB
KNOWN_WORDS = 250_000                 # whose hashes a task remembers
SLICE = 1 << 20                       # characters of text that are hashed together
ROWS = 1_000                          # sets whose lists are worked on together
FIRST, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# ---------------------------------------------------------- one text's set
class Words(dict):
    """Hashes of words; long words are not kept."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = value
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * STEP
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: list[str], width: int, known: Words) -> list[np.ndarray]:
    """Sorted distinct hashes of every text's word shingles; of all its words
    where they are fewer. Texts are hashed one behind the other."""
    words = [t.encode().lower().split() for t in texts]   # bytes: A-Z only, ASCII white space
    flat = [w for own in words for w in own]
    hashes = np.fromiter(map(known.__getitem__, flat), np.uint64, len(flat))
    full = _rolled(hashes, width) if len(flat) >= width else hashes[:0]
    out, at = [], 0
    for own in words:
        n = len(own)
        out.append(np.unique(full[at:at + n - width + 1] if n >= width else _rolled(hashes[at:at + n], n) if n
                             else hashes[:0]))
        at += n
    return out


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes) - width + 1
    h = np.full(n, FIRST)
    for k in range(width):
        h = mixed(h ^ hashes[k:k + n]) + FIRST
    return h


def slices(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in order, some together up to ``SLICE`` characters; NULL as
    an empty one."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def set_id(shingles: np.ndarray) -> int | None:
    import xxhash

    return int(signed(np.array([xxhash.xxh64_intdigest(shingles.tobytes())], np.uint64))[0]) if len(shingles) else None


def band_of(n: int) -> int:
    return n.bit_length() - 1


def set_lists(shingles: np.ndarray, percent: int) -> list[dict]:
    """What names a set in each band it joins: words, of which the first
    ``need`` in a common order are its keys; shingles where words are few."""
    n, out = len(shingles), []
    most = 100 * n // percent                             # shingles that a partner can have
    for band in range(band_of(n), band_of(most) + 1):
        top = 2 << band
        differ = (n + min(most, top - 1)) * (100 - percent) // (100 + percent)
        words = max(1, int(DENSITY * top))
        at = ((shingles >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)      # ascending
        start = np.append(0, np.flatnonzero(at[1:] != at[:-1]) + 1)
        value = np.bitwise_xor.reduceat(mixed(shingles), start)
        some = value != 0
        value, at = value[some], at[start][some]
        named = np.uint64(2 * band)
        out.append({"need": differ + 1,
                    "words": signed(mixed(mixed(value ^ FIRST) + mixed(at * np.uint64(128) + named)))})
        if len(value) <= differ:
            out.append({"need": differ + 1,
                        "words": signed(mixed(mixed(shingles) + mixed(np.array([named + np.uint64(1)]))))})
    return out


def parity_sketch(shingles: np.ndarray) -> list[int]:
    """One bit per shingle of the band's largest set, ``SKETCH`` at least; a
    sketch of twice the width folds into one of the next lower band."""
    width = max(SKETCH, 2 << band_of(len(shingles)))
    bits = np.bincount(((shingles >> np.uint64(6)) % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8").tolist()


# --------------------------------------------------------- passes over texts
LISTS = pa.list_(pa.struct([("need", pa.int64()), ("words", pa.list_(pa.int64()))]))


def text_hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def described(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``(doc_id, text_hash, row, sid, n, sketch, lists)`` for every row; ``row``
    is a random number, ``sid`` names the set, NULL for an empty one."""
    def run(batches):
        known, rng = Words(), np.random.default_rng()
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                sets = shingle_sets(texts, width, known)
                yield pa.record_batch([
                    batch.column(0).slice(at, len(texts)), pa.array([text_hash(t) for t in texts], pa.int64()),
                    pa.array(rng.integers(1 << 62, size=len(texts))),
                    pa.array([set_id(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([parity_sketch(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    pa.array([set_lists(s, percent) if len(s) else None for s in sets], LISTS)],
                    ["doc_id", "text_hash", "row", "sid", "n", "sketch", "lists"])
                at += len(texts)

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_hash long, row long, "
                               "sid long, n long, sketch array<long>, lists array<struct<need long, words array<long>>>")


def bit_filter(values: DataFrame, count: int = 0):
    """Broadcast bits of the hashes in the first column: built as bitmaps by
    the executors. 4 MB, or with their ``count`` 16 bits each up to 32 MB."""
    width = min(max(FILTER_BITS, (16 * count).bit_length()), MOST_FILTER_BITS)
    low = values.select(F.col(values.columns[0]).bitwiseAND(F.lit((1 << width) - 1)).alias("v"))
    maps = (low.groupBy(F.shiftright("v", 15).alias("at"))
            .agg(F.bitmap_construct_agg(F.col("v").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")).collect())
    bits = np.zeros((1 << (width - 15), 1 << 12), np.uint8)
    for row in maps:
        bits[row["at"]] = np.frombuffer(row["bits"], np.uint8)
    return values.sparkSession.sparkContext.broadcast(bits.ravel())


def may_hold(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def one_row_each(table: DataFrame):
    """Filter of rows, one for every set at least."""
    rows = table.where("sid IS NOT NULL").groupBy("sid").agg(F.min("row").alias("row"))
    return bit_filter(rows.select("row"), table.count())


def keys_of(table: DataFrame, once, last=None, only=None, among=None) -> DataFrame:
    """``(key, sid)``: the first ``need`` words of every list, those in the
    filter ``last`` behind the others. ``once``, ``only`` and ``among`` leave out
    rows, keys and sets that are not in them."""
    def picked(batch: pa.RecordBatch) -> pa.RecordBatch:
        sids, lists = np.asarray(batch.column(0)), batch.column(2)
        flat = lists.flatten()
        of = np.repeat(sids, np.asarray(pc.list_value_length(lists)))
        words = flat.field("words")
        size, need = np.asarray(pc.list_value_length(words)), np.asarray(flat.field("need"))
        keys = np.asarray(words.flatten())
        start = np.repeat(np.cumsum(size) - size, size)
        at = np.arange(len(keys)) - start
        if last is not None:                          # places with these words behind the others
            late = may_hold(last.value, keys)
            so_far = np.append(0, np.cumsum(late))
            before = so_far[:-1] - so_far[start]
            others = np.repeat(size, size) - (so_far[start + np.repeat(size, size)] - so_far[start])
            at = np.where(late, others + before, at - before)
        take = at < np.repeat(need, size)
        if only is not None:
            take &= may_hold(only.value, keys)
        return pa.record_batch([pa.array(keys[take]), pa.array(np.repeat(of, size)[take])], ["key", "sid"])

    def run(batches):
        for whole in batches:
            wanted = may_hold(once.value, np.asarray(whole.column(1)))
            if among is not None:
                wanted &= may_hold(among.value, np.asarray(whole.column(0)))
            whole = whole.filter(pa.array(wanted))
            for row in range(0, whole.num_rows, ROWS):
                yield picked(whole.slice(row, ROWS))

    return table.where("sid IS NOT NULL").select("sid", "row", "lists").mapInArrow(run, "key long, sid long")


def members_of(table: DataFrame, once, last=None, among=None) -> DataFrame:
    """Distinct ``(key, sid)`` of the keys that several rows have."""
    shared = write_once(keys_of(table, once, last, None, among).groupBy("key").agg(F.count("*").alias("rows"))
                        .where("rows > 1").select("key"), "jaccard-shared")
    rows = keys_of(table, once, last, bit_filter(shared, shared.count()), among).join(shared, "key")
    return write_once(rows.distinct(), "jaccard-keys")    # dealt by key already


def shingles_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(sid, shingles)`` of the sets in ``wanted`` (sid, text_hash; each
    once). Which of the filter's hits are wanted is decided by the join."""
    filtering = bit_filter(wanted.select("text_hash"))

    def run(batches):
        known, done = Words(), set()
        for batch in batches:
            for texts in slices(batch.column(0)):
                hashes = [text_hash(t) for t in texts]
                hit = may_hold(filtering.value, np.array(hashes, np.int64))
                hits = {h: t for h, t, own in zip(hashes, texts, hit) if own and h not in done}
                done.update(hits)                         # a copy in the same task
                if hits:
                    sets = shingle_sets(list(hits.values()), width, known)
                    yield pa.record_batch([pa.array(list(hits), pa.int64()),
                                           pa.array([signed(s) for s in sets], pa.list_(pa.int64()))],
                                          ["text_hash", "shingles"])

    found = docs.select("text").mapInArrow(run, "text_hash long, shingles array<long>").join(wanted, "text_hash")
    return write_once(found.groupBy("text_hash", "sid").agg(F.first("shingles").alias("shingles"))
                      .select("sid", "shingles"), "jaccard-shingles")


# ------------------------------------------------------------------- search
class Search:
    """Candidates and verified links between the sets of one corpus. ``sets``
    is ``(sid, n, sketch, text_hash, f0, f1, f2, f3)``: the f are the sketch
    folded to 256 bits."""

    def __init__(self, docs: DataFrame, sets: DataFrame, width: int, percent: int):
        self.docs, self.sets, self.width, self.percent = docs, sets, width, percent

    def shingles(self, sids: DataFrame) -> DataFrame:
        return shingles_of(self.docs, self.sets.select("sid", "text_hash").join(sids, "sid", "left_semi"), self.width)

    def near(self, a: str, b: str, full: bool = True) -> Column:
        """Sizes and sketches of the sets ``a`` and ``b`` allow a link; the
        sketches in full or as folded."""
        p, n, m = self.percent, F.col(f"{a}.n"), F.col(f"{b}.n")
        # 256 bits of either sketch, in plain columns, sort out most; the rest
        # is compared in full
        part = sum((F.bit_count(F.col(f"{a}.f{i}").bitwiseXOR(F.col(f"{b}.f{i}"))) for i in range(4)), F.lit(0))
        sized = 100 * F.least(n, m) >= p * F.greatest(n, m)
        most = (100 - p) * (n + m)
        may = sized & ((100 + p) * part <= most)
        if not full:
            return may
        x, y = F.col(f"{a}.sketch"), F.col(f"{b}.sketch")
        flips = F.zip_with(_folded(x, y), _folded(y, x), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
        distance = F.aggregate(flips, F.lit(0), lambda s, u: s + u)
        return F.when(may, (100 + p) * distance <= most).otherwise(F.lit(False))

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``(a, b)`` that are linked."""
        one, two = self.sets.alias("one"), self.sets.alias("two")
        near = (pairs.distinct().join(one, F.col("a") == F.col("one.sid")).join(two, F.col("b") == F.col("two.sid"))
                .where(self.near("one", "two")))
        near = write_once(near.select("a", "b", (F.col("one.n") + F.col("two.n")).alias("sizes")), "jaccard-candidates")
        if near.isEmpty():
            return near.select("a", "b")
        shingles = self.shingles(near.select(F.explode(F.array("a", "b")).alias("sid")))
        for side in ("b", "a"):
            near = near.join(shingles.select(F.col("sid").alias(side), F.col("shingles").alias(f"s_{side}")), side)
        both = F.size(F.array_intersect("s_a", "s_b"))
        near = near.withColumn("both", both).where(100 * F.col("both") >= self.percent * (F.col("sizes") - F.col("both")))
        return write_once(near.select("a", "b"), "jaccard-links")

    def probe(self, members: DataFrame, links: DataFrame | None = None,
              roots: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """``links`` and those found by comparing every set with one of each
        of its keys; the components' roots; and ``(key, sid, size, root)`` of
        the keys that have several components then. ``members`` are distinct
        ``(key, sid)``; ``roots`` are those of some of ``links``."""
        sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.min("sid").alias("a"))
        sized = write_once(members.join(sizes.where("size > 1"), "key"), "jaccard-members")
        if links is None:
            links = self.links(sized.select("a", F.col("sid").alias("b")).where("a < b"))
            roots = components(links)
        left = write_once(divided(sized.drop("a"), roots), "jaccard-divided")
        links = links.unionByName(self.links(self.led(left)))
        roots = components(links)
        return links, roots, write_once(divided(left.drop("root"), roots), "jaccard-divided")

    def led(self, rooted: DataFrame) -> DataFrame:
        """Every set of a key with a set of the component that has most sets of
        the key; which one, varies between keys."""
        parts = rooted.groupBy("key", "root").agg(F.count("*").alias("n"), F.min(F.struct(
            F.xxhash64("key", "sid"), "sid")).alias("m"))
        lead = parts.groupBy("key").agg(F.max(F.struct("n", "root", F.col("m.sid").alias("sid"))).alias("lead"))
        return (rooted.join(lead, "key").where("root <> lead.root")
                .select(F.least("sid", "lead.sid").alias("a"), F.greatest("sid", "lead.sid").alias("b")))

    def compared(self, rooted: DataFrame, full: bool) -> DataFrame:
        """Candidates ``(a, b)`` with a common key, of different components.
        Both sides of the join are the same rows, which are dealt out once;
        they carry their sketches in ``full`` or only folded."""
        names = ("n", "f0", "f1", "f2", "f3", *(["sketch"] if full else []))
        rows = rooted.select("key", "sid", "root").join(self.sets.select("sid", *names), "sid")
        one, two = rows.alias("one"), rows.alias("two")
        return one.join(two, (F.col("one.key") == F.col("two.key")) & (F.col("one.sid") < F.col("two.sid"))
                        & (F.col("one.root") != F.col("two.root")) & self.near("one", "two", full)).select(
                            F.col("one.sid").alias("a"), F.col("two.sid").alias("b"))

    def all_links(self, table: DataFrame, once, members: DataFrame) -> DataFrame:
        """Links that connect whatever is connected."""
        links, roots, left = self.probe(members)
        links = links.unionByName(self.links(self.compared(left.where(F.col("size") <= BUCKET), full=False)))
        left = left.where(F.col("size") > BUCKET)
        if left.isEmpty():
            return links
        last, among = bit_filter(left.select("key")), bit_filter(left.select("sid"))
        late = members_of(table, once, last, among).join(self.sets.select("sid"), "sid", "left_semi")
        links, _, left = self.probe(late, links, roots)
        return links.unionByName(self.links(self.compared(left, full=True)))


def divided(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` of the keys with several components, and their ``root``."""
    rooted = (members.join(roots.withColumnRenamed("node", "sid"), "sid", "left")
              .withColumn("root", F.coalesce("root", "sid")))
    keys = (rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
            .where("low <> high").select("key"))
    return rooted.join(keys, "key")


def _folded(sketch: Column, other: Column) -> Column:
    """``sketch`` in the width of ``other``, if that is half of it."""
    n = F.size(other)
    halves = F.zip_with(F.slice(sketch, 1, n), F.slice(sketch, n + 1, n), lambda u, v: u.bitwiseXOR(v))
    return F.when(F.size(sketch) <= n, sketch).otherwise(halves)


def near_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, root)`` for every row: the size of
    its set and the smallest id reachable over links. ``root`` names the
    component also where all its ids are NULL; it is NULL for empty sets."""
    if not 50 <= percent <= 100:                          # partners are at most a band apart
        raise ValueError(f"percent is {percent}; between 50 and 100 are supported")
    table = write_once(described(docs, width, percent), "jaccard-sets")
    once = one_row_each(table)
    members = members_of(table, once)
    sids = members.select("sid").distinct()
    sets = table.join(sids, "sid", "left_semi").groupBy("sid").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("text_hash").alias("text_hash"))
    folds = {f"f{i}": F.expr(f"aggregate(filter(sketch, (x, k) -> k % 4 = {i}), 0L, (s, x) -> s ^ x)") for i in range(4)}
    sets = write_once(sets.withColumns(folds), "jaccard-sketches")
    links = Search(docs, sets, width, percent).all_links(table, once, members)
    rooted = (table.select("doc_id", "sid", F.col("n").alias("n_shingles"))
              .join(components(links).withColumnRenamed("node", "sid"), "sid", "left")
              .withColumn("root", F.coalesce("root", "sid")))
    lowest = rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.where("root IS NOT NULL").join(lowest, "root")
    alone = rooted.where("root IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", "root"]
    return named.select(*columns).unionByName(alone.select(*columns))
