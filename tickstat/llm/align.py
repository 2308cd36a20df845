"""Alignment of two tokenizers over the same text, by merge-path partitioning.

Both token sequences of a text end at the same bytes in all, so their ends are
two sorted lists. Merging them walks through every pair of overlapping tokens:
at each step one token of A and one of B lie on top of each other, and the one
that ends first makes way. Diagonal k of the merge holds all ways to have taken
k ends; a binary search along it finds the one the merge goes through. So the
diagonals ``PIECE`` steps apart divide the merge into pieces of equal work that
need nothing of each other: every piece is a row of a matrix, sorted by itself,
and emits its overlaps. Where both tokens end together a group ends; a group
that goes on over the border of a piece is stitched by a running sum of the
group ends of all pieces. Texts of a slice are merged as one text, so a short
text costs no piece of its own, and a long one fills many.

A link is a pair of overlapping tokens. How many documents hold a pair of ids
linked is counted over the corpus: documents are packed into chunks of
``CHUNK`` bytes of text, a chunk ships its distinct pairs only, and gets back
their counts, so what is shuffled are the chunks' dictionaries and not the
links. The table of pairs is bounded by the two vocabularies, a pair that
every chunk has by the number of chunks.

Defined results: texts that are NULL, empty, or that a tokenizer does not give
back byte for byte have no tokens: zeros and an empty digest. Repeated rows
count as documents of their own. A text over ``PART`` bytes is encoded in
parts, cut in front of a space between two ASCII letters, which no token of
either vocabulary can span (checked when they are loaded).

Given the pattern that a byte-level vocabulary cuts texts by, A's ids come
from the tiktoken library with the ranks of that vocabulary, which is four
times faster than the tokenizers library and gives the same ids if the ids are
in the order of the merges (checked; the tests compare the two over all code
points and tokens). Parts with a very long run of white space, over which its
pattern matching fails, and other vocabularies go through tokenizers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import write_once

PIECE = 1024                  # merge steps of a piece
BLOCK = 512                   # pieces that are in memory at once
SLICE = 1 << 20               # bytes of text that are merged together
CHUNK = 8 << 20               # bytes of text that share a dictionary of pairs
PART = 1 << 20                # bytes of text that are encoded together
SPELL = 1 << 18               # tokens that are written out at once
WHITE = re.compile(r"\s{10000}")
LAST = np.iinfo(np.int64).max
BETWEEN = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


# ------------------------------------------------------------- vocabularies
def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable
    bytes of Latin-1 for themselves, the others from U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Spelling:
    """Byte strings by number, and the concatenation of many of them."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def write(self, which: np.ndarray) -> bytes:
        size = self.size[which]
        at = np.arange(size.sum()) + np.repeat(self.start[which] - (np.cumsum(size) - size), size)
        return self.data[at].tobytes()

    def spells(self, which: np.ndarray, text: bytes) -> bool:
        if self.size[which].sum() != len(text):
            return False
        done = 0
        for k in range(0, len(which), SPELL):
            part = self.write(which[k:k + SPELL])
            if text[done:done + len(part)] != part:
                return False
            done += len(part)
        return True


class Tokenizers:
    """Tokenizers A (a tokenizers file, cut by ``pattern``) and B (a
    sentencepiece model)."""

    def __init__(self, a_json: str, b_model: bytes, pattern: str | None = None):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        letters, known = _byte_letters(), self.a.get_vocab()
        a_bytes = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(pieces)]
        self.spell_a, self.spell_b = Spelling(a_bytes), Spelling(b_bytes)
        self.fast = None
        model, cut = json.loads(a_json)["model"], json.loads(a_json)["pre_tokenizer"] or {}
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", [])]
        if (pattern and cut.get("type") == "ByteLevel" and not cut["add_prefix_space"]
                and all(model["vocab"][m] == 256 + k for k, m in enumerate(merges))):
            import tiktoken

            ranks = {a_bytes[i]: i for i in range(256 + len(merges))}
            self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cuts = not any(re.search(rb"[A-Za-z] [A-Za-z]", t) for t in a_bytes + b_bytes)
        self.b_bits = (len(b_bytes) - 1).bit_length()
        self.bits = self.b_bits + (len(a_bytes) - 1).bit_length()
        # ids in decimal, with each of the signs that can follow one
        self.signs = Spelling([f"{i}{s}".encode() for i in range(max(len(a_bytes), len(b_bytes)))
                               for s in (",", "|", ";", "")])

    def parts(self, text: str) -> list[str]:
        """Space + text, cut where neither tokenizer can span; every part
        starts with a space."""
        text = " " + text
        if len(text) <= PART or not self.cuts:
            return [text]
        out, start = [], 0
        while len(text) - start > PART:
            cut = BETWEEN.search(text, start + PART)
            if cut is None:
                break
            out.append(text[start:cut.start()])
            start = cut.start()
        return [*out, text[start:]]

    def a_ids(self, part: str) -> np.ndarray:
        if self.fast is None or len(part) >= 10_000 and WHITE.search(part):
            return np.array(self.a.encode(part, add_special_tokens=False).ids, np.int64)
        return self.fast.encode_to_numpy(part, disallowed_special=()).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and B for every text; none for a text that either does
        not give back."""
        a, b = [], []
        for text in texts:
            if not text:
                a.append(np.empty(0, np.int64))
                b.append(np.empty(0, np.int64))
                continue
            parts = self.parts(text)
            own_a = np.concatenate([self.a_ids(p) for p in parts])
            own_b = np.concatenate([np.array(self.b.encode(p[1:]), np.int64) for p in parts])
            want = b" " + text.encode()
            if not (self.spell_a.spells(own_a, want) and self.spell_b.spells(own_b, want)):
                own_a = own_b = np.empty(0, np.int64)
            a.append(own_a)
            b.append(own_b)
        return a, b


# -------------------------------------------------------------- merge path
def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first k of both merged (a before b
    where equal), for every diagonal k: binary searches side by side."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while True:
        todo = np.flatnonzero(low < high)
        if not len(todo):
            return low
        mid = (low[todo] + high[todo]) // 2
        first = a[mid] <= b[diagonals[todo] - 1 - mid]
        low[todo[first]] = mid[first] + 1
        high[todo[~first]] = mid[~first]


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE,
             block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Tokens of A and B that overlap, given their ends, in the order of the
    text; and the tokens of A and of B that end together. Blocks of pieces."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, piece), total)
    at_a = crossings(a, b, diagonals)
    at_b = diagonals - at_a
    before = np.append(-1, a)                          # end of the token of A in front
    for k in range(0, len(diagonals) - 1, block):
        cut_a, cut_b = at_a[k:k + block + 1], at_b[k:k + block + 1]
        own_a, own_b = np.diff(cut_a), np.diff(cut_b)
        rows = np.arange(len(own_a))
        keys = np.full((len(rows), piece), LAST)
        of_a, of_b = np.repeat(rows, own_a), np.repeat(rows, own_b)
        from_a, from_b = np.arange(cut_a[0], cut_a[-1]), np.arange(cut_b[0], cut_b[-1])
        keys[of_a, from_a - cut_a[of_a]] = a[from_a] * 2
        keys[of_b, own_a[of_b] + from_b - cut_b[of_b]] = b[from_b] * 2 + 1
        keys.sort(axis=1)                              # every piece by itself
        is_b = keys & 1
        y = np.cumsum(is_b, axis=1) - is_b
        x = np.arange(piece) - y + cut_a[:-1, None]
        y += cut_b[:-1, None]
        steps = own_a.sum() + own_b.sum()              # only the last piece is not full
        x, y, keys = x.ravel()[:steps], y.ravel()[:steps], keys.ravel()[:steps]
        together = ((keys & 1) == 1) & (keys >> 1 == before[x])
        yield x[~together], y[~together], x[together] - 1, y[together]


class Slice:
    """The alignment of some texts: counts, digests, and every text's distinct
    pairs of linked ids with how often they are linked."""

    def __init__(self, tools: Tokenizers, texts: list[str], keep_groups: bool = False):
        a, b = tools.encode(texts)
        self.n_a, self.n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        a, b = np.concatenate(a), np.concatenate(b)
        docs = len(texts)
        doc_a, doc_b = np.repeat(np.arange(docs), self.n_a), np.repeat(np.arange(docs), self.n_b)
        ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        keys, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        self.n_links = np.zeros(docs, np.int64)
        if len(a):
            for x, y, last_a, last_b in overlaps(np.cumsum(tools.spell_a.size[a]), np.cumsum(tools.spell_b.size[b])):
                ends_a[last_a], ends_b[last_b] = True, True
                doc = doc_a[x]
                self.n_links += np.bincount(doc, minlength=docs)
                one, n = np.unique(doc << tools.bits | a[x] << tools.b_bits | b[y], return_counts=True)
                keys.append(one)
                times.append(n)
        self.n_groups = np.bincount(doc_a[ends_a], minlength=docs)
        keys, times = np.concatenate(keys), np.concatenate(times)
        one, where = np.unique(keys, return_inverse=True)       # a text may lie in several blocks
        self.times = np.bincount(where, times, len(one)).astype(np.int64)
        self.doc, self.pair = one >> tools.bits, one & ((1 << tools.bits) - 1)
        self.sha256, self.groups = self._write(tools, a, b, ends_a, ends_b, keep_groups)

    def _write(self, tools: Tokenizers, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray,
               keep: bool) -> tuple[list[str], list[str] | None]:
        """Groups in writing: a group's tokens of A stand behind the tokens of
        B of all groups before, its tokens of B behind its tokens of A."""
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        upto_a, upto_b = np.append(0, np.flatnonzero(ends_a) + 1), np.append(0, np.flatnonzero(ends_b) + 1)
        signs = np.empty(len(a) + len(b), np.int64)
        signs[np.arange(len(a)) + upto_b[group_a]] = a * 4 + ends_a
        closing = np.zeros(len(b), np.int64)
        closing[ends_b] = 2
        own = self.n_b[self.n_b > 0]
        closing[np.cumsum(own) - 1] = 3                        # nothing follows the last token
        signs[np.arange(len(b)) + upto_a[group_b + 1]] = b * 4 + closing
        stops = np.cumsum(self.n_a + self.n_b)
        hashes, texts = [hashlib.sha256() for _ in stops], [[] for _ in stops]
        for at in range(0, len(signs), SPELL):
            which = signs[at:at + SPELL]
            written, ends = tools.signs.write(which), np.append(0, np.cumsum(tools.signs.size[which]))
            first, final = np.searchsorted(stops, [at, at + len(which) - 1], "right")
            for doc in range(first, final + 1):
                low, high = (stops[doc - 1] if doc else 0) - at, stops[doc] - at
                part = written[ends[max(low, 0)]:ends[min(high, len(which))]]
                hashes[doc].update(part)
                if keep:
                    texts[doc].append(part.decode())
        sha256 = [h.hexdigest() if n else "" for h, n in zip(hashes, self.n_a)]
        return sha256, ["".join(t) for t in texts] if keep else None


# -------------------------------------------------------------------- Spark
def _packed(values: np.ndarray) -> bytes:
    """Numbers in the narrowest of 1, 2, 4 or 8 bytes, which goes in front."""
    kind = np.min_scalar_type(int(values.max()) if len(values) else 0)
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def encoded(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False,
            pattern: str | None = None) -> tuple[DataFrame, int]:
    """A table with a row per document (``pairs`` NULL) and one per chunk:
    its dictionary of pairs and how many of its documents hold each; and the
    bits of a pair that are the id of B. A document's pairs are places in its
    chunk's dictionary."""
    spark = docs.sparkSession
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:      # some MB, whatever the corpus
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    counted = ("n_a", "n_b", "n_groups", "n_links")

    def run(batches):
        tools = Tokenizers(*files.value, pattern)
        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, Slice]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            pairs = np.concatenate([s.pair for _, s in held])
            known, at = np.unique(pairs, return_inverse=True)
            places, times, rows, done = [], [], 0, 0
            for _, s in held:
                cuts = np.searchsorted(s.doc, np.arange(len(s.n_a) + 1))
                for low, high in zip(cuts[:-1], cuts[1:]):
                    places.append(_packed(at[done + low:done + high]))
                    times.append(_packed(s.times[low:high]))
                done += len(s.pair)
                rows += len(s.n_a)
            ids = pa.concat_arrays([*(i for i, _ in held), pa.nulls(1, held[0][0].type)])
            columns = [pa.array([task << 32 | number] * (rows + 1), pa.int64()), ids]
            columns += [pa.array([*np.concatenate([getattr(s, n) for _, s in held]).tolist(), None], pa.int64())
                        for n in counted]
            columns += [pa.array([*(h for _, s in held for h in s.sha256), None], pa.string()),
                        pa.array([*places, None], pa.binary()), pa.array([*times, None], pa.binary()),
                        pa.array([*[None] * rows, known], pa.list_(pa.int64())),
                        pa.array([*[None] * rows, np.bincount(at, minlength=len(known))], pa.list_(pa.int64()))]
            if keep_groups:
                columns.append(pa.array([*(g for _, s in held for g in s.groups), None], pa.string()))
            names = ["chunk", "doc_id", *counted, "groups_sha256", "places", "times", "pairs", "docs"]
            number += 1
            held.clear()
            return pa.record_batch(columns, names + ["groups"] * keep_groups)

        for batch in batches:
            start, waiting, in_slice = 0, [], 0
            for k, text in enumerate(batch.column(1)):
                waiting.append(text.as_py() or "")
                in_slice += len(waiting[-1])
                if in_slice >= SLICE or k == batch.num_rows - 1:
                    held.append((batch.column(0).slice(start, k + 1 - start), Slice(tools, waiting, keep_groups)))
                    size += in_slice
                    start, waiting, in_slice = k + 1, [], 0
                    if size >= CHUNK:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    src = docs.select("doc_id", "text")
    schema = (f"chunk long, doc_id {src.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, "
              "n_links long, groups_sha256 string, places binary, times binary, pairs array<long>, docs array<long>")
    from sentencepiece import SentencePieceProcessor

    b_bits = (SentencePieceProcessor(model_proto=files.value[1]).get_piece_size() - 1).bit_length()
    return write_once(src.mapInArrow(run, schema + ", groups string" * keep_groups), "aligned"), b_bits


def pair_counts(table: DataFrame, b_bits: int) -> DataFrame:
    """``(pair, a, b, docs, best)``: documents that hold a pair of ids linked,
    and whether no other pair with the same id of A is held by more. The pairs
    of an id of A are at most the vocabulary of B."""
    uses = table.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "docs")).alias("u"))
    counts = (uses.groupBy(F.col("u.pairs").alias("pair")).agg(F.sum("u.docs").alias("docs"))
              .withColumns({"a": F.shiftright("pair", b_bits), "b": F.col("pair").bitwiseAND(F.lit((1 << b_bits) - 1))}))
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))


def align(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False,
          pattern: str | None = None) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256)`` for every row, and with ``keep_groups`` the ``groups``
    themselves: ``a1,a2|b1;a3|b2,b3``."""
    table, b_bits = encoded(docs, path_a, path_b, keep_groups, pattern)
    same = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    rest = ["groups_sha256", *["groups"] * keep_groups]
    places = table.where("pairs IS NOT NULL").select(F.col("chunk").alias("of"), F.posexplode("pairs").alias("at", "pair"))
    known = places.join(pair_counts(table, b_bits).select("pair", "docs", "best"), "pair").drop("pair")

    def score(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        at = np.asarray(pairs.column("at").to_numpy(), np.int64)
        docs, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        docs[at] = pairs.column("docs").to_numpy()
        best[at] = np.asarray(pairs.column("best").to_pylist(), bool)
        n_best, count_sum = [], []
        for where, times in zip(texts.column("places").to_pylist(), texts.column("times").to_pylist()):
            where, times = _unpacked(where), _unpacked(times)
            n_best.append(int(times @ best[where]))
            count_sum.append(int(times @ docs[where]))
        return pa.table({**{n: texts.column(n) for n in same}, "n_best": pa.array(n_best, pa.int64()),
                         "count_sum": pa.array(count_sum, pa.int64()), **{n: texts.column(n) for n in rest}})

    texts = table.where("pairs IS NULL").select("chunk", *same, *rest, "places", "times")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
              "groups_sha256 string")
    return (texts.groupBy("chunk").cogroup(known.groupBy("of"))
            .applyInArrow(score, schema + ", groups string" * keep_groups))
