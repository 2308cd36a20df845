"""Language identification with interpolated Kneser-Ney character models.

Text is lower-cased; letters are kept and every run of other characters is one
space. Each language has a 4-gram model: Spark counts the 4-grams of all its
training texts (whole texts, partial counts per batch), and derives from the
distinct ones the continuation counts that Kneser-Ney uses for the lower
orders, with contexts' totals and numbers of types.

The model is stored as sorted arrays of hashed n-grams, one per order, with a
column of counts per language. Hashes have ``HASH_BITS`` bits, so an array has
at most 2**HASH_BITS rows whatever the corpus; n-grams that share a hash share
counts. The model is gathered on the driver and broadcast: up to 8 tables of
2**HASH_BITS rows, with a column per language. That is some hundred MB for the
languages of a few scripts and several GB for ``MAX_LANGUAGES`` of them, which
a driver has to be given.

A text gets the language of lowest cross-entropy per character. Rejection is
calibrated per language on the training counts: mean and spread of the
per-character cross-entropy of its own training text, widened for short texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_once

ORDER = 4                     # characters of 16 bits in a 64-bit code
HASH_BITS = 20
MAX_LANGUAGES = 200           # more labels are refused, not cut
CHUNK = 1 << 21               # characters worked on together
TEMPER = 32                   # characters after which the score stops sharpening
REJECT_SPREADS = 6.0
REJECT_SLACK = 1.25


# ------------------------------------------------------------------- codes
def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def symbols(texts: list[str], letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of several texts one after another, each followed by three
    zeros (the context of the next text's start), and each text's first and
    end position."""
    low = [t.lower() for t in texts]
    cp = np.frombuffer("".join(t + "\0\0\0\0" for t in low).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.array([len(t) for t in low], np.int64)
    stop = np.cumsum(sizes + 4) - 4
    is_letter = letter[cp]
    pad = np.zeros(len(cp), bool)
    for k in (1, 2, 3):
        pad[stop + k] = True
    # letters beyond 16 bits are folded; 32 is no letter, so it stays the space
    sym = np.where(is_letter, np.maximum((cp ^ (cp >> 16)) & 0xFFFF, 33), 32).astype(np.uint16)
    sym[pad] = 0
    after_letter = np.concatenate([[False], is_letter[:-1]])
    keep = is_letter | pad | after_letter
    kept = np.cumsum(keep)
    end = kept[stop + 1] - 1
    start = np.concatenate([[0], end[:-1] + 3])
    return sym[keep], start, end


def codes_between(sym: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Code of the n-gram that ends at each position."""
    part = sym[max(0, lo - ORDER + 1):hi].astype(np.uint64)
    part = np.concatenate([np.zeros(ORDER - 1 - (lo - max(0, lo - ORDER + 1)), np.uint64), part])
    n = hi - lo
    code = np.zeros(n, np.uint64)
    for k in range(ORDER):
        code = code << np.uint64(16) | part[k:k + n]
    return code.view(np.int64)


def chunks(texts: list[str]):
    """Runs of texts of about ``CHUNK`` characters."""
    held, total, first = [], 0, 0
    for k, text in enumerate(texts):
        held.append(text)
        total += len(text)
        if total >= CHUNK:
            yield first, held
            held, total, first = [], 0, k + 1
    if held:
        yield first, held


def hash_codes(codes: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of a long column, cut to the hash bits."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def rotate(x, r):
        return x << np.uint64(r) | x >> np.uint64(64 - r)

    k = rotate(codes.view(np.uint64) * p2, 31) * p1
    h = (np.uint64(42) + p5 + np.uint64(8)) ^ k
    h = rotate(h, 27) * p1 + p4
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    h = h ^ h >> np.uint64(32)
    return (h & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64)


# ---------------------------------------------------------------- training
def count_ngrams(train: DataFrame) -> DataFrame:
    """``(lang, code, n)`` over all rows of ``(lang, text)``."""
    def run(batches):
        import pandas as pd

        letter = letter_table()
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for _, held in chunks(texts):
                    sym, _, _ = symbols(held, letter)
                    for lo in range(0, len(sym), CHUNK):
                        hi = min(lo + CHUNK, len(sym))
                        codes = codes_between(sym, lo, hi)
                        which, found = pd.factorize(codes[sym[lo:hi] != 0])
                        counts = np.bincount(which, minlength=len(found))
                        yield pa.record_batch([pa.array([lang] * len(found), pa.string()), pa.array(found),
                                               pa.array(counts.astype(np.int64))], ["lang", "code", "n"])

    return (train.select(F.col("lang").cast("string").alias("lang"), "text").where("lang IS NOT NULL")
            .mapInArrow(run, "lang string, code long, n long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n")))


def train(labelled: DataFrame) -> dict:
    """The model of all ``(lang, text)`` rows (NULL languages are left out)."""
    grams = write_once(count_ngrams(labelled), "langid-grams")
    tables, own = [], F.xxhash64("code").bitwiseAND(F.lit((1 << HASH_BITS) - 1)).alias("id")
    now = grams
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            mask = (1 << 16 * order) - 1
            now = now.groupBy("lang", F.col("code").bitwiseAND(F.lit(mask).cast("long")).alias("code")).agg(
                F.count("*").alias("n"))
        tables.append(now.groupBy("lang", own).agg(F.sum("n").alias("n"))
                      .select("lang", F.lit(2 * order).alias("kind"), "id", "n", F.lit(0).cast("long").alias("types")))
        context = now.groupBy("lang", F.shiftrightunsigned("code", 16).alias("code")).agg(
            F.sum("n").alias("n"), F.count("*").alias("types"))
        tables.append(context.groupBy("lang", own).agg(F.sum("n").alias("n"), F.sum("types").alias("types"))
                      .select("lang", F.lit(2 * order + 1).alias("kind"), "id", "n", "types"))
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    langs = sorted(r["lang"] for r in grams.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found = whole.toPandas()              # at most 2**HASH_BITS rows per language and table
    model: dict = {"langs": langs, "grams": [], "contexts": []}
    number = {lang: k for k, lang in enumerate(langs)}
    column = found["lang"].map(number).to_numpy(np.int64) if len(found) else np.zeros(0, np.int64)
    for order in range(1, ORDER + 1):
        for name, kind in (("grams", 2 * order), ("contexts", 2 * order + 1)):
            rows = (found["kind"] == kind).to_numpy()
            ids, at = np.unique(found["id"].to_numpy(np.int64)[rows], return_inverse=True)
            n = np.zeros((len(ids), len(langs)), np.float32)
            n[at, column[rows]] = found["n"].to_numpy(np.float32)[rows]
            entry = {"ids": ids.astype(np.int32), "n": n}
            if name == "contexts":
                entry["types"] = np.zeros_like(n)
                entry["types"][at, column[rows]] = found["types"].to_numpy(np.float32)[rows]
            else:
                once, twice = (n == 1).sum(axis=0), (n == 2).sum(axis=0)
                entry["discount"] = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
            model[name].append(entry)
    model["letters"] = max((int((g["n"] > 0).any(axis=1).sum()) for g in model["grams"][:1]), default=0) + 1
    model["limits"] = calibrate(grams, model)
    return model


def log_probabilities(model: dict, codes: np.ndarray) -> np.ndarray:
    """Base-2 log probability of each n-gram's last character in each language."""
    p = np.full((len(codes), len(model["langs"])), 1.0 / model["letters"])
    raw = codes.view(np.uint64)
    for order in range(1, ORDER + 1):
        gram = (raw & np.uint64((1 << 16 * order) - 1)) if order < ORDER else raw
        c = _rows(model["grams"][order - 1], "n", gram)
        total = _rows(model["contexts"][order - 1], "n", gram >> np.uint64(16))
        types = _rows(model["contexts"][order - 1], "types", gram >> np.uint64(16))
        d = model["grams"][order - 1]["discount"]
        seen = total > 0
        p = np.where(seen, (np.maximum(c - d, 0) + d * types * p) / np.where(seen, total, 1), p)
    return np.log2(np.maximum(p, 1e-12))


def _rows(entry: dict, name: str, codes: np.ndarray) -> np.ndarray:
    """Rows of a sorted hash array; zeros where the n-gram is not in it."""
    if not len(entry["ids"]):
        return np.zeros((len(codes), entry[name].shape[1]))
    ids = hash_codes(codes.view(np.int64))
    at = np.minimum(np.searchsorted(entry["ids"], ids), len(entry["ids"]) - 1)
    return np.where((entry["ids"][at] == ids)[:, None], entry[name][at], 0.0)


def calibrate(grams: DataFrame, model: dict) -> list[tuple[float, float]]:
    """Mean and spread of the cross-entropy of each language's own training text."""
    shared = grams.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            langs = shared.value["langs"]
            bits = -log_probabilities(shared.value, np.asarray(batch.column(1)).astype(np.int64))
            which = np.array([langs.index(x) for x in batch.column(0).to_pylist()], np.int64)
            own, n = bits[np.arange(len(which)), which], np.asarray(batch.column(2)).astype(float)
            rows = [np.bincount(which, w, minlength=len(langs)) for w in (n, n * own, n * own * own)]
            yield pa.record_batch([pa.array(langs, pa.string()), *map(pa.array, rows)], ["lang", "n", "s", "ss"])

    sums = {r["lang"]: r for r in grams.select("lang", "code", "n")
            .mapInArrow(run, "lang string, n double, s double, ss double").groupBy("lang")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()}
    out = []
    for lang in model["langs"]:
        mean = sums[lang]["s"] / sums[lang]["n"]
        out.append((mean, max(0.0, sums[lang]["ss"] / sums[lang]["n"] - mean * mean) ** 0.5))
    return out


# -------------------------------------------------------------- prediction
def score_texts(model: dict, texts: list[str], letter: np.ndarray) -> list[tuple]:
    """``(language, score, bits per character, accepted)`` of whole texts."""
    import pandas as pd

    out: list[tuple] = []
    langs = model["langs"]
    for _, held in chunks(texts):
        sym, start, end = symbols(held, letter)
        total = np.zeros((len(held), len(langs)))
        for lo in range(0, len(sym), CHUNK):
            hi = min(lo + CHUNK, len(sym))
            which, found = pd.factorize(codes_between(sym, lo, hi))
            logs = log_probabilities(model, found)
            logs[found & 0xFFFF == 0] = 0.0
            a, b = np.clip(start, lo, hi) - lo, np.clip(end, lo, hi) - lo
            for k in range(len(langs)):
                sums = np.concatenate([[0.0], np.cumsum(logs[:, k][which])])
                total[:, k] += sums[b] - sums[a]
        n = end - start
        for k, size in enumerate(n.tolist()):
            if not size or not langs:
                out.append(("und", 0.0, None, False))
                continue
            bits = -total[k] / size
            best = int(np.argmin(np.round(bits, 9)))
            score = 1.0 / float(np.sum(2.0 ** ((bits[best] - bits) * min(size, TEMPER))))
            mean, spread = model["limits"][best]
            limit = REJECT_SLACK * mean + REJECT_SPREADS * spread / size ** 0.5
            out.append((langs[best], round(min(1.0, score), 6), round(float(bits[best]), 6), bool(bits[best] <= limit)))
    return out


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, lang_pred, score, bits, accepted)`` of every row. Texts
    without a letter (NULL and empty ones too) are ``und`` with score 0; with
    an empty model all are. Equal entropies go to the first language by name.
    ``accepted`` is false beyond the language's calibrated limit."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        letter = letter_table()
        for batch in batches:
            rows = score_texts(shared.value, [t or "" for t in batch.column(1).to_pylist()], letter)
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.record_batch([batch.column(0), *(pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds))],
                                  ["doc_id", "lang_pred", "score", "bits", "accepted"])

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, "
                               "score double, bits double, accepted boolean")
