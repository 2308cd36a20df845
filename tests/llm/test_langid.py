import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from conftest import SF_MID

from tickstat.llm import langid, queries


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op2_language_id(spark, SF_MID).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 150
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.accepted for r in held) / len(held) > 0.9


def test_hash_is_sparks(spark):
    codes = [0, 1, -1, 2**63 - 1, -(2**63), 123456789012345]
    want = [r.h & (1 << langid.HASH_BITS) - 1 for r in spark.createDataFrame([(c,) for c in codes], "c long")
            .selectExpr("xxhash64(c) h").collect()]
    assert langid.hash_codes(np.array(codes, np.int64)).tolist() == want


def normal(text):
    out = "".join(c if c.isalpha() else " " for c in text.lower())
    return " ".join(out.split()) + (" " if out.strip() else "")


class Brute:
    """Interpolated Kneser-Ney by dictionaries, without hashing."""

    def __init__(self, texts):
        tokens = Counter()
        for t in texts:
            s = "\0\0\0" + normal(t)
            tokens.update(s[i - 3:i + 1] for i in range(3, len(s)))
        self.grams, now = {4: tokens}, tokens
        for order in (3, 2, 1):
            now = Counter(g[1:] for g in now)
            self.grams[order] = now
        self.total, self.types, self.discount = {}, {}, {}
        for order, grams in self.grams.items():
            self.total[order], self.types[order] = Counter(), Counter()
            for g, n in grams.items():
                self.total[order][g[:-1]] += n
                self.types[order][g[:-1]] += 1
            once, twice = sum(n == 1 for n in grams.values()), sum(n == 2 for n in grams.values())
            self.discount[order] = min(0.95, max(0.1, once / max(once + 2 * twice, 1)))

    def p(self, gram, uniform):
        p = uniform
        for order in (1, 2, 3, 4):
            g = gram[-order:]
            total = self.total[order][g[:-1]]
            if total:
                d = self.discount[order]
                p = (max(self.grams[order][g] - d, 0) + d * self.types[order][g[:-1]] * p) / total
        return p

    def bits(self, text, uniform):
        s = "\0\0\0" + normal(text)
        return -sum(math.log2(max(self.p(s[i - 3:i + 1], uniform), 1e-12)) for i in range(3, len(s))) / (len(s) - 3)


@pytest.fixture
def texts():
    rng = random.Random(2)
    vocab = {"aa": ["tha", "ing", "Éne", "or"], "bb": ["zzo", "qui", "la", "ñe"]}
    return [(lang, " ".join(rng.choice(words) + rng.choice(words) for _ in range(30)) + "! 12,\n") for lang, words in vocab.items()
            for _ in range(12)]


def test_entropies_equal_brute_force(spark, texts, monkeypatch):
    model = langid.train(spark.createDataFrame([*texts, (None, "left out"), ("aa", None)], "lang string, text string"))
    assert model["langs"] == ["aa", "bb"]
    brute = {k: Brute([t for lang, t in texts if lang == k]) for k in model["langs"]}
    seen = {g for b in brute.values() for g in b.grams[1]}
    assert model["letters"] == len(seen) + 1
    probe = [t for _, t in texts[::5]] + ["the zoo", "x", "É", "", "12 !", "a b" * 40, "\U0001D400 letter", "ñ" * 700]
    letter = langid.letter_table()
    for chunk in (langid.CHUNK, 64):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        for text, (lang, score, bits, _) in zip(probe, langid.score_texts(model, probe, letter)):
            if not normal(text).strip():
                assert (lang, score, bits) == ("und", 0.0, None)
                continue
            want = {k: b.bits(text, 1 / model["letters"]) for k, b in brute.items()}
            best = min(want, key=want.get)
            assert lang == best and bits == pytest.approx(want[best], rel=1e-3)


def test_rejects_what_it_never_saw(spark, texts):
    model = langid.train(spark.createDataFrame(texts, "lang string, text string"))
    rows = langid.score_texts(model, [texts[0][1], "xkcd wvut jjjj pppp bbbb mmmm " * 5], langid.letter_table())
    assert rows[0][3] and not rows[1][3]


def test_odd_rows(spark, odd_documents):
    docs = odd_documents.select("doc_id", "text", "lang")
    got = langid.predict(docs, langid.train(docs)).collect()
    assert len(got) == docs.count()
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 5)} == {"und"}
    empty = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, empty).collect()} == {"und"}
    assert langid.predict(docs.limit(0), empty).count() == 0
