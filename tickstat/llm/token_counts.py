"""Token counts per section, attributed through character offsets.

A document is encoded once, as a whole. Its tokens lie one after another, so
their offsets are the running sum of their lengths; its sections do too, so
finding the sections a token overlaps is an interval join of two sorted lists
of a document, done with binary search inside the task that encoded it (no
token ever crosses a shuffle). Offsets are those of the UTF-8 bytes; section
borders fall between characters, so a token starts in a section by bytes
exactly when it does by characters.

Tokens that cross a border are allocated by ``rule``:

* ``start`` (default): to the section that holds the token's first byte;
* ``most``: to the section that holds most of its bytes, the earliest of equals;
* ``split``: to all it touches, by their share of its bytes.

Under every rule the sections' tokens add up to the document's tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import Encoder, _shared, encode_stream

RULES = ("start", "most", "split")


def sections_of(text: str) -> list[int]:
    """Byte ends of the paragraphs of a text: a paragraph ends after its line
    feed, the last one at the end of the text. An empty text has none."""
    lines = text.encode().split(b"\n")
    ends = np.cumsum([len(x) + 1 for x in lines])
    ends[-1] -= 1
    return [int(e) for e in (ends[:-1] if len(ends) > 1 and not lines[-1] else ends) if e]


def attribute(lengths: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many tokens that cross a border touch it."""
    stop = np.cumsum(lengths)
    start = stop - lengths
    first = np.searchsorted(ends, start, "right")
    final = np.searchsorted(ends, stop - 1, "right")
    n = len(ends)
    cross = np.flatnonzero(first != final)
    touched = np.zeros(n)
    counts = np.bincount(first[first == final], minlength=n).astype(float)
    begins = np.concatenate([[0], ends[:-1]])
    for t in cross.tolist():
        span = np.arange(first[t], final[t] + 1)
        share = np.minimum(ends[span], stop[t]) - np.maximum(begins[span], start[t])
        touched[span] += 1
        if rule == "start":
            counts[span[0]] += 1
        elif rule == "most":
            counts[span[share.argmax()]] += 1
        else:
            counts[span] += share / lengths[t]
    return counts, touched


def section_tokens(docs: DataFrame, path: str, pattern: str, rule: str = "start") -> DataFrame:
    """``(doc_id, n_tokens, section, n_bytes, section_tokens, crossing)``:
    one row per paragraph of every text, and one row with section -1 and no
    bytes for a text without any (NULL or empty). ``section_tokens`` is a
    double because the ``split`` rule allocates fractions; ``crossing`` counts
    the tokens that touch the section and also another one."""
    if rule not in RULES:
        raise ValueError(f"rule {rule!r}; known: {RULES}")
    shared = _shared(docs.sparkSession, path)

    def run(batches):
        import regex

        encoder, cut = Encoder(shared.value), regex.compile(pattern)
        size = np.array([len(t) for t in encoder.tokens], np.int64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            names = ["doc_id", "n_tokens", "section", "n_bytes", "section_tokens", "crossing"]
            take, cols = [], [[] for _ in names[1:]]
            lengths: list[np.ndarray] = []
            for k, ids, last in encode_stream(encoder, cut, texts):
                lengths.append(size[np.array(ids, np.int64)])
                if not last:
                    continue
                of, lengths = np.concatenate(lengths), []
                ends = np.array(sections_of(texts[k] or ""), np.int64)
                if not len(ends):
                    rows = [[0], [-1], [0], [0.0], [0]]
                else:
                    counts, touched = attribute(of, ends, rule)
                    rows = [[len(of)] * len(ends), range(len(ends)), np.diff(ends, prepend=0).tolist(),
                            counts.tolist(), touched.astype(int).tolist()]
                take += [k] * len(rows[0])
                for col, row in zip(cols, rows):
                    col.extend(row)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            yield pa.record_batch([batch.column(0).take(pa.array(take, pa.int64())),
                                   *(pa.array(c, kind) for c, kind in zip(cols, kinds))], names)

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
                               "section long, n_bytes long, section_tokens double, crossing long")
