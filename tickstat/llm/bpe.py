"""Byte-level BPE encoding and decoding with padded numpy matrices.

The text is cut by the tokenizer's pattern; every distinct piece of a chunk is
one row of a matrix of byte ids, rows of similar length share a matrix. In
each round every row merges its leftmost pair of minimum rank: the pair
becomes one id, its second column is taken out of the row (so the matrix gets
one column narrower) and only the two neighbouring pair ranks are looked up
again, in an open-addressing hash table of pairs. Rows without a mergeable
pair leave the matrix.

Pieces longer than ``LONG_PIECE`` bytes (junk without spaces) would need a
round per merge over a very wide row; they are merged one at a time from a
heap ordered by (rank, position), which gives the same ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

NONE = np.int32(2**31 - 1)        # rank of a pair that does not merge
EMPTY = np.int64(-1)              # free slot of the pair table
PAIR_BITS = 17                    # ids are below 2**17
LONG_PIECE = 256
WIDTHS = (4, 6, 8, 12, 16, 24, 32, 64, 128, LONG_PIECE)
WIDTH_OF = [next(w for w in WIDTHS if n <= w) for n in range(LONG_PIECE + 1)]
CELLS = 1 << 20                   # of one matrix
CACHE_WORDS = 300_000             # pieces whose ids a task remembers
FLUSH_PIECES = 200_000            # pieces that are encoded together


# ------------------------------------------------------------- vocabulary
def load_vocabulary(path: str) -> dict:
    """Rank file -> plain arrays that can be broadcast (bounded by the
    vocabulary: some 50,000 tokens, under 20 MB with the pair table)."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    size = max(ranks.values()) + 1
    if size >= 1 << PAIR_BITS:
        raise ValueError(f"vocabulary of {size} ids; at most {(1 << PAIR_BITS) - 1} are supported")
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    keys, values = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                keys.append(left << PAIR_BITS | right)
                values.append(rank)
    slots, ranks_of = _pair_table(np.array(keys, np.int64), np.array(values, np.int32))
    return {"tokens": tokens, "slots": slots, "ranks": ranks_of,
            "bytes": np.array([ranks[bytes([i])] for i in range(256)], np.int32)}


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _pair_table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing with linear probing, at most a quarter full."""
    bits = max(4, int(4 * len(keys)).bit_length())
    slots, ranks = np.full(1 << bits, EMPTY), np.zeros(1 << bits, np.int32)
    at, todo = _slot(keys, bits), np.arange(len(keys))
    while len(todo):
        free = todo[slots[at[todo]] == EMPTY]
        slots[at[free]] = keys[free]                    # the last of several wins
        won = free[slots[at[free]] == keys[free]]
        ranks[at[won]] = values[won]
        todo = todo[slots[at[todo]] != keys[todo]]
        at[todo] = (at[todo] + 1) & ((1 << bits) - 1)
    return slots, ranks


class Encoder:
    """Encodes and decodes pieces of text; one per task."""

    def __init__(self, vocabulary: dict):
        self.tokens = vocabulary["tokens"]
        self.slots, self.ranks = vocabulary["slots"], vocabulary["ranks"]
        self.byte_ids = vocabulary["bytes"]
        self.bits = len(self.slots).bit_length() - 1
        self.whole = {t: i for i, t in enumerate(self.tokens) if t}
        # ranks of pairs of bytes; row and column 256 are padding
        self.byte_pairs = np.full((257, 257), NONE, np.int32)
        left, right = np.divmod(np.arange(1 << 16), 256)
        self.byte_pairs[:256, :256] = self.pair_ranks(self.byte_ids[left], self.byte_ids[right]).reshape(256, 256)
        self.cache: dict[str, tuple[int, ...]] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair; NONE where it does not merge or has padding."""
        keys = (left.astype(np.int64) << PAIR_BITS) | right
        keys[right < 0] = EMPTY - 1
        at = _slot(keys, self.bits)
        got = self.slots[at]
        out = np.where(got == keys, self.ranks[at], NONE)
        todo = np.flatnonzero((got != keys) & (got != EMPTY) & (right >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.slots) - 1)
            got = self.slots[at[todo]]
            hit = got == keys[todo]
            out[todo[hit]] = self.ranks[at[todo[hit]]]
            todo = todo[~hit & (got != EMPTY)]
        return out

    def merge_matrix(self, symbols: np.ndarray, length: np.ndarray, rows: list[int], out: list) -> None:
        """Merge all rows of a padded matrix of bytes (256: padding);
        ``out[row]`` gets a row's ids. A row that is still in the matrix has
        merged once in every round, so its length is known."""
        rows, merged = np.array(rows), 0
        rank = self.byte_pairs[symbols[:, :-1], symbols[:, 1:]]
        ids = np.append(self.byte_ids, np.int32(-1))[symbols]
        while len(ids):
            each = np.arange(len(ids))
            if rank.shape[1]:
                at = rank.argmin(axis=1)
                best = rank[each, at]
                done = best == NONE
            else:
                done = np.ones(len(ids), bool)
            if done.any():
                for row, got, n in zip(rows[done].tolist(), ids[done].tolist(), (length[done] - merged).tolist()):
                    out[row] = tuple(got[:n])
                keep = ~done
                if not keep.any():
                    return
                ids, rank, rows, at, best = ids[keep], rank[keep], rows[keep], at[keep], best[keep]
                length, each = length[keep], np.arange(len(ids))
            merged += 1
            ids[each, at] = best
            wide = ids.shape[1]
            ids = ids[np.arange(wide) != (at + 1)[:, None]].reshape(len(ids), wide - 1)
            rank = rank[np.arange(wide - 1) != at[:, None]].reshape(len(ids), wide - 2)
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.pair_ranks(ids[left, at[left] - 1], ids[left, at[left]])
            right = np.flatnonzero(at < wide - 2)
            rank[right, at[right]] = self.pair_ranks(ids[right, at[right]], ids[right, at[right] + 1])

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """One long piece: linked symbols and a heap of (rank, position)."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        first = self.pair_ranks(ids[:-1], ids[1:])
        heap = [(int(r), i, int(ids[i]), int(ids[i + 1]))
                for i, r in enumerate(first.tolist()) if r != NONE]
        heapq.heapify(heap)
        ids = ids.tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def push(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                pair = self.tokens[ids[i]] + self.tokens[ids[j]]
                rank = self.whole.get(pair)
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return tuple(i for i in ids if i >= 0)

    def encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of every piece; a piece that is a token is that token."""
        out: list = [None] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            got = self.whole.get(piece)
            if got is not None:
                out[k] = (got,)
            elif len(piece) > LONG_PIECE:
                out[k] = self.merge_long(piece)
            else:
                by_width.setdefault(WIDTH_OF[len(piece)], []).append(k)
        for width, rows in by_width.items():
            step = max(1, CELLS // width)
            for start in range(0, len(rows), step):
                part = rows[start:start + step]
                held = [pieces[k] for k in part]
                length = np.array(list(map(len, held)))
                raw = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in held]), np.uint8)
                symbols = raw.reshape(len(part), width).astype(np.int16)
                symbols[np.arange(width) >= length[:, None]] = 256
                self.merge_matrix(symbols, length, part, out)
        return out

    def learn(self, pieces: Iterable[str]) -> None:
        """Put the ids of all these pieces into the cache."""
        fresh = [p for p in set(pieces) if p not in self.cache]
        if len(self.cache) + len(fresh) > CACHE_WORDS:
            self.cache.clear()
            fresh = list(set(pieces))
        self.cache.update(zip(fresh, self.encode_pieces([p.encode() for p in fresh])))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode_stream(encoder: Encoder, pattern, texts: Iterable[str | None]) -> Iterator[tuple[int, list[int], bool]]:
    """``(text number, ids, last)`` for whole texts in order; a very long text
    comes in several parts. Pieces of many texts are encoded together."""
    held: list[tuple[int, list[str], bool]] = []
    count = 0

    def flush():
        encoder.learn(list(chain.from_iterable(p for _, p, _ in held)))
        ids_of = encoder.cache.__getitem__
        for k, pieces, last in held:
            yield k, list(chain.from_iterable(map(ids_of, pieces))), last
        held.clear()

    for k, text in enumerate(texts):
        text = text or ""
        found = (iter(pattern.findall(text)) if len(text) < FLUSH_PIECES
                 else (m.group() for m in pattern.finditer(text)))
        while True:
            pieces = list(islice(found, FLUSH_PIECES))
            last = len(pieces) < FLUSH_PIECES
            held.append((k, pieces, last))
            count += len(pieces)
            if count >= FLUSH_PIECES:
                yield from flush()
                count = 0
            if last:
                break
    yield from flush()


# -------------------------------------------------------------- operators
def _shared(spark, path: str):
    return spark.sparkContext.broadcast(load_vocabulary(path))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids array<int>)``: the ids of every whole text."""
    shared = _shared(docs.sparkSession, path)

    def run(batches):
        import regex

        encoder, cut = Encoder(shared.value), regex.compile(pattern)
        for batch in batches:
            ids: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for k, part, _ in encode_stream(encoder, cut, batch.column(1).to_pylist()):
                ids[k].extend(part)
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, decoded binary)`` of ``(doc_id, ids)`` rows (NULL: empty)."""
    shared = _shared(encoded.sparkSession, path)

    def run(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            out = [encoder.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    src = encoded.select("doc_id", "ids")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row:
    encodes the whole text, decodes the ids and digests both. The ids stay in
    the task, part by part, so a very long text needs little memory. A NULL
    or empty text has no tokens and the digests of nothing."""
    shared = _shared(docs.sparkSession, path)

    def run(batches):
        import regex

        encoder, cut = Encoder(shared.value), regex.compile(pattern)
        decimal = [b"%d" % i for i in range(len(encoder.tokens))]
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
            for _, ids, last in encode_stream(encoder, cut, batch.column(1).to_pylist()):
                if n and ids:
                    of_ids.update(b" ")
                of_ids.update(b" ".join(map(decimal.__getitem__, ids)))
                of_text.update(encoder.decode(ids))
                n += len(ids)
                if last:
                    counts.append(n)
                    id_digests.append(of_ids.hexdigest())
                    text_digests.append(of_text.hexdigest())
                    n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()),
                 pa.array(text_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
