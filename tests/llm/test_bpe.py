import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken
from conftest import SF_SMALL

from tickstat.llm import bpe, queries, token_counts

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(ids):
    return hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_pieces_equal_the_library(reference):
    rng = random.Random(3)
    encoder = bpe.Encoder(bpe.load_vocabulary(PATH))
    pieces = [bytes(rng.choices(alphabet, k=rng.randint(1, 60))).decode("latin-1") for alphabet in
              (b"abcdefghijklmnopqrstuvwxyz", b"ab", b" ", b"ethaonis") for _ in range(200)]
    pieces += ["a" * 300, "ab" * 700, " " * 1000, "é" * 200, "\U0001F600" * 99,
               "".join(rng.choices("etaoinshrdlu", k=5000))]
    got = encoder.encode_pieces([p.encode() for p in pieces])
    for piece, ids in zip(pieces, got):
        assert list(ids) == reference._core_bpe.encode_single_piece(piece.encode())
        assert encoder.decode(ids) == piece.encode()


def test_long_texts_come_in_parts(reference, monkeypatch):
    monkeypatch.setattr(bpe, "FLUSH_PIECES", 50)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 60)
    encoder = bpe.Encoder(bpe.load_vocabulary(PATH))
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choices("abcde", k=rng.randint(1, 9))) for _ in range(n)) for n in (0, 5, 400, 49, 50)]
    ids = [[] for _ in texts]
    for k, part, _ in bpe.encode_stream(encoder, regex.compile(P.PATTERN), texts):
        ids[k].extend(part)
    assert ids == [reference.encode_ordinary(t) for t in texts]


def test_query_equals_the_library(spark, reference):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op3_bpe(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = reference.encode_ordinary(rows[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(ids))
        assert r.decoded_sha256 == hashlib.sha256((rows[r.doc_id] or "").encode()).hexdigest()


def test_odd_rows(spark, odd_documents, reference):
    rows = odd_documents.collect()
    got = bpe.round_trip(odd_documents, PATH, P.PATTERN).collect()
    want = sorted((r.doc_id is None, r.doc_id, len(reference.encode_ordinary(r.text or "")),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) if r.doc_id is not None else
                  (True, -1, len(reference.encode_ordinary(r.text or "")),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows)
    assert sorted((r.doc_id is None, -1 if r.doc_id is None else r.doc_id, r.n_tokens, r.decoded_sha256)
                  for r in got) == want
    assert bpe.round_trip(odd_documents.limit(0), PATH, P.PATTERN).count() == 0


def test_encode_then_decode(spark, odd_documents):
    encoded = bpe.encode(odd_documents, PATH, P.PATTERN)
    decoded = bpe.decode(encoded, PATH).collect()
    texts = sorted((r.text or "").encode() for r in odd_documents.collect())
    assert sorted(bytes(r.decoded) for r in decoded) == texts


# ------------------------------------------------------------ token counts
@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_add_up(spark, odd_documents, reference, rule):
    got = token_counts.section_tokens(odd_documents, PATH, P.PATTERN, rule).collect()
    assert len({(r.doc_id, r.n_tokens) for r in got}) >= 6
    by_text = {}
    for r in odd_documents.collect():
        by_text.setdefault(r.doc_id, []).append(len(reference.encode_ordinary(r.text or "")))
    for doc_id, totals in by_text.items():
        rows = [r for r in got if r.doc_id == doc_id]
        assert abs(sum(r.section_tokens for r in rows) - sum(totals)) < 1e-6
    assert token_counts.section_tokens(odd_documents.limit(0), PATH, P.PATTERN, rule).count() == 0


def brute_sections(reference, text, rule):
    ids = reference.encode_ordinary(text)
    spans, at = [], 0
    for i in ids:
        size = len(reference.decode_single_token_bytes(i))
        spans.append((at, at + size))
        at += size
    ends = token_counts.sections_of(text)
    sections = list(zip([0, *ends], ends))
    counts, crossing = [0.0] * len(sections), [0] * len(sections)
    for a, b in spans:
        shares = [max(0, min(b, e) - max(a, s)) for s, e in sections]
        touched = [k for k, x in enumerate(shares) if x]
        if len(touched) > 1:
            for k in touched:
                crossing[k] += 1
        if rule == "start":
            counts[touched[0]] += 1
        elif rule == "most":
            counts[shares.index(max(shares))] += 1
        else:
            for k in touched:
                counts[k] += shares[k] / (b - a)
    return counts, crossing


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_equal_brute_force(spark, documents, reference, rule):
    texts = ["a b\n\n\n  c d\n", "x\n\n", "\n\n\n\n", "one line", "l1\r\n   l2\n\t\tl3 \n\n\n\n\nend", "é\néé\n!!!\n\n???"]
    docs = documents([(k, t, "en", "s") for k, t in enumerate(texts)])
    got = token_counts.section_tokens(docs, PATH, P.PATTERN, rule).collect()
    for k, text in enumerate(texts):
        counts, crossing = brute_sections(reference, text, rule)
        rows = sorted((r for r in got if r.doc_id == k), key=lambda r: r.section)
        assert [round(r.section_tokens, 9) for r in rows] == [round(c, 9) for c in counts]
        assert [r.crossing for r in rows] == crossing
        assert sum(r.n_bytes for r in rows) == len(text.encode())
