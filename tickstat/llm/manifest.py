"""Merkle manifest of a dataset: a tree of digests per group (language), and a
tree over the groups' roots.

Order by bitmaps: the rank of a document among its group's ids is a popcount,
so no sort of the documents gives the leaves their places. Ids are dealt by
(group, id >> 12); what meets there is merged into a bitmap of 4,096 bits,
stored without the zero bytes at either end. The popcounts of the bitmaps are
a directory, summed up in two steps (over 1,024 bitmaps, then over those), and
a leaf's place is its bitmap's entry plus the bits in front of its own.

Levels by slot arrays: ``SPAN`` = 8**4 leaves share a key (place >> 12); each
fills the slot of its place in the key's array, and the array is folded over
four levels at once, so a tree of n leaves takes log(n) / 12 shuffles, each a
4,096th of the one before. Paths go down the same way: an array meets the path
of its top node, and every slot's path is its run's others followed by that.

Defined results: NULL ids come first in their group, ordered by leaf digest.
Rows that repeat an id are ordered by leaf digest; a bitmap holds an id once,
so buckets with more rows than bits are ranked by a window (an id repeated
without end has its rows in one, spilling, window partition). Equal rows are
leaves of their own, side by side, so their proofs differ. A NULL group comes
first. Ids are integers. Groups are ranked in one window: they are the
languages of a corpus, not its documents.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_once

ARITY_BITS = 3                        # 8 nodes become one
DEPTH = 4                             # levels folded at once
SPAN_BITS = ARITY_BITS * DEPTH
BUCKET_BITS = 12                      # ids of one bitmap
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left string, right string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields: ``-`` for NULL, else UTF-8 byte count, ``:``, value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


# ------------------------------------------------------------------- places
def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (doc_id, group, leaf, ...) with ``pos``, the place in the
    group by ascending id, and ``n``, the size of the group."""
    number = F.col("doc_id").cast("long")
    first_hex = F.conv(F.substring("leaf", 1, 4), 16, 10).cast("long")
    dealt = leaves.withColumns({
        "bucket": F.coalesce(F.shiftright(number, BUCKET_BITS), first_hex - F.lit(1 << 60)),
        "bit": number.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)),
    }).repartition("group", "bucket")
    low, high = F.shiftright(F.min("bit"), 3), F.shiftright(F.max("bit"), 3)
    maps = write_once(dealt.groupBy("group", "bucket").agg(
        F.count("*").alias("rows"), low.alias("skipped"),
        F.substring(F.bitmap_construct_agg("bit"), low + 1, high - low + 1).alias("bits")), "bitmaps")
    directory = _summed(maps.select("group", "bucket", "rows"))
    sizes = directory.groupBy("group").agg(F.sum("rows").alias("n"))
    whole = F.col("bit").isNotNull() & (F.bitmap_count("bits") == F.col("rows"))
    found = (dealt.join(maps.drop("rows"), ["group", "bucket"])
             .join(directory, ["group", "bucket"]).join(sizes, "group"))
    before = F.shiftright("bit", 3) - F.col("skipped")
    own = F.conv(F.hex(F.substring("bits", before + 1, F.lit(1))), 16, 10).cast("long")
    below = F.expr("shiftleft(1L, CAST(bit & 7 AS INT)) - 1L")
    rank = F.bitmap_count(F.substring("bits", F.lit(1), before)) + F.bit_count(own.bitwiseAND(below))
    repeated = Window.partitionBy("group", "bucket").orderBy(F.col("doc_id").asc_nulls_first(), "leaf")
    names = [*leaves.columns, "n"]
    by_bits = found.where(whole).select(*names, (F.col("base") + rank).alias("pos"))
    by_window = found.where(~whole).withColumn("pos", F.col("base") + F.row_number().over(repeated) - 1)
    return by_bits.unionByName(by_window.select(*names, "pos"))


def _summed(counts: DataFrame) -> DataFrame:
    """The popcount directory: ``base``, the rows in the buckets before."""
    counts = counts.withColumn("over", F.shiftright("bucket", 10))
    upper = counts.groupBy("group", "over").agg(F.sum("rows").alias("part"))
    so_far = Window.partitionBy("group").orderBy("over").rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.withColumn("start", F.coalesce(F.sum("part").over(so_far), F.lit(0)))
    inside = Window.partitionBy("group", "over").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inner = counts.withColumn("inner", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
    return inner.join(upper.drop("part"), ["group", "over"]).select(
        "group", "bucket", "rows", (F.col("start") + F.col("inner")).alias("base"))


# -------------------------------------------------------------------- trees
def levels(nodes: list[str], n: int) -> list[list[str]]:
    """A slot array and its levels above, ``DEPTH`` at most. ``n`` is the
    number of nodes of the whole level: a tree of one node has no more."""
    out = [nodes]
    while n > 1 and len(out) <= DEPTH:
        low = out[-1]
        out.append([digest("".join(low[i:i + 8])) for i in range(0, len(low), 8)])
        n = -(-n // 8)
    return out


def _slots(table: pa.Table) -> tuple[list[str], list[int], int]:
    """The slot array of a key, and the slot of every row."""
    slot = [p & ((1 << SPAN_BITS) - 1) for p in table.column("pos").to_pylist()]
    nodes = [""] * len(slot)
    for at, value in zip(slot, table.column("node").to_pylist()):
        nodes[at] = value
    return nodes, slot, table.column("n")[0].as_py()


def _run(level: list[str], i: int) -> tuple[str, str]:
    """The others of the run of node i, before and after it."""
    start = i & ~7
    return "".join(level[start:i]), "".join(level[i + 1:start + 8])


def fold(node: str, path: list[tuple[str, str]]) -> str:
    """The root that a node and the others of its runs give."""
    for left, right in path:
        node = digest(left + node + right)
    return node


def _key(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("span", F.shiftright("pos", SPAN_BITS))


def _tops(nodes: DataFrame, kind: str) -> DataFrame:
    """One node for every ``SPAN`` of them: ``(group, pos, n, node)``."""
    def run(table: pa.Table) -> pa.Table:
        array, _, n = _slots(table)
        folded = levels(array, n)
        return pa.table({"group": table.column("group")[:1], "pos": table.column("span")[:1],
                         "n": pa.array([-(-n // 8 ** (len(folded) - 1))], pa.int64()),
                         "node": [folded[-1][0]]})

    return (_key(nodes).select("group", "span", "pos", "n", "node").groupBy("group", "span")
            .applyInArrow(run, f"group {kind}, pos long, n long, node string"))


def raised(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the tables above it, the last with one node per group."""
    kind = nodes.schema["group"].dataType.simpleString()
    tables, n = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while n > 1:
        tables.append(write_once(_tops(tables[-1], kind), "merkle"))
        n = -(-n >> SPAN_BITS)
    return tables


def lowered(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Paths of the nodes of a table, from those of the table above."""
    def run(low: pa.Table, high: pa.Table) -> pa.Table:
        array, slot, n = _slots(low)
        folded, above = levels(array, n), high.column("path")[0].as_py()
        out = []
        for i in slot:
            own = [_run(level, i >> ARITY_BITS * k) for k, level in enumerate(folded[:-1])]
            out.append([{"left": a, "right": b} for a, b in own] + above)
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return pa.table({"group": low.column("group"), "pos": low.column("pos"), "path": pa.array(out, kind)})

    kind = nodes.schema["group"].dataType.simpleString()
    return (_key(nodes).select("group", "span", "pos", "n", "node").groupBy("group", "span")
            .cogroup(paths.select("group", F.col("pos").alias("span"), "path").groupBy("group", "span"))
            .applyInArrow(run, f"group {kind}, pos long, path {PATH}"))


def _proofs(leaves: DataFrame, paths: DataFrame) -> DataFrame:
    """Proof and recomputed root of every leaf; see ``Manifest.proofs``."""
    id_type = leaves.schema["doc_id"].dataType.simpleString()

    def run(low: pa.Table, high: pa.Table) -> pa.Table:
        array, slot, n = _slots(low)
        folded = levels(array, n)
        above = [(step["left"], step["right"]) for step in high.column("path")[0].as_py()]
        rest: dict[int, list[tuple[str, str]]] = {}        # the path of the first node above a leaf
        proof, root = [], []
        for i, changed in zip(slot, low.column("changed").to_pylist()):
            path = [_run(array, i)] if len(folded) > 1 else []
            if i >> ARITY_BITS not in rest:
                rest[i >> ARITY_BITS] = [_run(level, i >> ARITY_BITS * k)
                                         for k, level in enumerate(folded[1:-1], 1)] + above
            path += rest[i >> ARITY_BITS]
            proof.append(digest("".join(a + b for a, b in path)))
            root.append(fold(changed if changed is not None else array[i], path))
        size = len(slot)
        return pa.table({
            "doc_id": low.column("doc_id"), "pos": low.column("pos"), "leaf": low.column("node"),
            "subroot": pa.array(high.column("subroot").to_pylist()[:1] * size, pa.string()),
            "root": pa.array(high.column("root").to_pylist()[:1] * size, pa.string()),
            "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(root, pa.string())})

    names = ("group", "span", "pos", "n", "node", "changed", "doc_id")
    return (_key(leaves).select(*names).groupBy("group", "span")
            .cogroup(paths.select("group", F.col("pos").alias("span"), "path", "subroot", "root").groupBy("group", "span"))
            .applyInArrow(run, f"doc_id {id_type}, pos long, leaf string, subroot string, root string, "
                               "proof_sha256 string, folded_root string"))


# ----------------------------------------------------------------- manifest
@dataclass
class Manifest:
    """``leaves`` (doc_id, group, pos, n, node, changed), the tables of nodes
    above them, and the tree over the groups (group NULL)."""

    leaves: DataFrame
    tables: list[DataFrame]
    over: list[DataFrame]

    def _roots(self) -> DataFrame:
        root = self.over[-1].select("group", F.col("node").alias("root"))
        return (self.over[0].select("group", "name", F.col("node").alias("subroot")).join(root, "group")
                .select(F.col("name").alias("group"), "subroot", "root"))

    def groups(self) -> DataFrame:
        """``(group, subroot, root)``: what the manifest publishes."""
        return self._roots().withColumn("group", F.when(F.col("group") != "", F.substr("group", F.lit(2))))

    def proofs(self) -> DataFrame:
        """One row per leaf: ``proof_sha256``, the digest of the others of its
        runs from the leaf to the root, and ``folded_root``, the root that
        ``changed`` (else the leaf) gives with them."""
        paths = self.over[-1].select("group", "pos", F.array().cast(PATH).alias("path"))
        for nodes in reversed(self.over[:-1]):
            paths = write_once(lowered(nodes, paths), "merkle-paths")
        names = self.over[0].select("pos", F.col("name").alias("group"))
        paths = paths.drop("group").join(names, "pos").select("group", F.lit(0).cast("long").alias("pos"), "path")
        for nodes in reversed(self.tables[1:-1]):
            paths = write_once(lowered(nodes, paths), "merkle-paths")
        return _proofs(self.leaves, paths.join(self._roots(), "group"))


def build(docs: DataFrame, changed: Column | None = None, fields: tuple[str, ...] = FIELDS,
          group: str = "lang") -> Manifest:
    """The manifest of ``docs``. ``changed`` is a column of leaf digests to be
    held against it (NULL: the leaf itself), see ``tampered``."""
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = write_once(docs.select(
        "doc_id", named.alias("group"), leaf_digest([F.col(c) for c in fields]).alias("leaf"),
        (F.lit(None).cast("string") if changed is None else changed).alias("changed")), "leaves")
    leaves = write_once(placed(leaves).withColumnRenamed("leaf", "node"), "merkle-leaves")
    tables = raised(leaves)
    place = Window.orderBy("group")
    roots = tables[-1].select("group", "node")
    over = write_once(
        roots.select(F.col("group").alias("name"), (F.row_number().over(place) - 1).cast("long").alias("pos"), "node")
        .withColumns({"group": F.lit(""), "n": F.count("*").over(Window.partitionBy(F.lit(0)))}), "merkle-over")
    return Manifest(leaves, tables, raised(over))


def tampered(fields: tuple[str, ...] = FIELDS) -> Column:
    """The leaf digest after tampering: where 3 divides the CRC-32 of the
    decimal id, A-Z of the text are lower-cased; NULL elsewhere and for NULL
    ids."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered_text = F.translate("text", upper, upper.lower())
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, leaf_digest([lowered_text if c == "text" else F.col(c) for c in fields]))
