import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tickstat.llm import align, queries

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def tools():
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        return align.Tokenizers(a.read(), b.read(), P.PATTERN)


def spans(ids, entries):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(entries[i])))
        at += len(entries[i])
    return out


class Brute:
    """Whole texts through both libraries, one token at a time."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        letters, extra = {}, 0
        for byte in range(256):
            letters[chr(byte) if byte in keep else chr(256 + extra)] = byte
            extra += byte not in keep
        self.a_entry = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab().items()}
        self.b_entry = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_entry[i] = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def links(self, text):
        """(groups in writing, number of groups, links, n_a, n_b)."""
        if not text:
            return "", 0, [], 0, 0
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        sa, sb = spans(a, self.a_entry), spans(b, self.b_entry)
        want = (" " + text).encode()
        if b"".join(self.a_entry[i] for i in a) != want or b"".join(self.b_entry[i] for i in b) != want:
            return "", 0, [], 0, 0
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, start = [], 0
        for e in ends:
            groups.append(",".join(str(i) for i, (s, f) in zip(a, sa) if s >= start and f <= e) + "|"
                          + ",".join(str(i) for i, (s, f) in zip(b, sb) if s >= start and f <= e))
            start = e
        links = [(i, j) for i, (s, e) in zip(a, sa) for j, (t, f) in zip(b, sb) if s < f and t < e]
        return ";".join(groups), len(groups), links, len(a), len(b)

    def table(self, rows):
        found = [(i, *self.links(t)) for i, t in rows]
        docs, highest = Counter(), defaultdict(int)
        for _, _, _, links, _, _ in found:
            docs.update(set(links))
        for (i, _), n in docs.items():
            highest[i] = max(highest[i], n)
        return sorted(((i, n_a, n_b, n, len(links), sum(docs[x] == highest[x[0]] for x in links),
                        sum(docs[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if n_a else "")
                       for i, text, n, links, n_a, n_b in found), key=str)


def test_both_libraries_give_the_same_ids(tools):
    """tiktoken with the file's ranks against tokenizers: every code point
    among letters, digits, signs and spaces, every token, long runs."""
    assert tools.fast is not None
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}b1{c}2.{c}.{c}{c} {c}" for c in map(chr, points[i:i + 128])) for i in range(0, len(points), 128)]
    whole = [t.decode("utf-8", "ignore") for t in
             (tools.spell_a.data[a:a + n].tobytes() for a, n in zip(tools.spell_a.start, tools.spell_a.size))]
    texts += whole + ["x" * 100_000, " " * 9_000 + "x", "\n" * 9_000, "0123456789abcdef" * 5_000]
    for text, want in zip(texts, tools.a.encode_batch(texts, add_special_tokens=False)):
        assert tools.a_ids(text).tolist() == want.ids
    for text in (" " * 1_200_000, "\n\t" * 300_000 + "x"):
        assert tools.a_ids(text).tolist() == tools.a.encode(text, add_special_tokens=False).ids


def rows_of(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


TEXTS = ["Hello world, this is a test.", "naïve café \U0001F600 déjà-vu", "a▁b", "<|endoftext|> and </s> <unk>",
         "tabs\t\tand\r\nlines  \n\n  two  spaces ", " ", "\n", "x" * 300, "日本語のテキスト", "\x00\x01", "é Å",
         "don't 12345 $%^&*()", "", None, "same text", "same text"]


def test_brute_force(spark, documents):
    docs = documents([(k, t, "en", "s") for k, t in enumerate(TEXTS)])
    want = Brute().table(list(enumerate(TEXTS)))
    assert rows_of(align.align(docs, A, B)) == want
    assert rows_of(align.align(docs, A, B, pattern=P.PATTERN)) == want


def test_query_equals_brute_force_on_short_documents(spark, monkeypatch):
    """All documents up to 1,500 characters of the small table, in many chunks."""
    monkeypatch.setattr(align, "CHUNK", 20_000)
    monkeypatch.setattr(align, "SLICE", 5_000)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) < 1500").select("doc_id", "text")
    assert rows_of(align.align(docs, A, B, pattern=P.PATTERN)) == Brute().table([tuple(r) for r in docs.collect()])
    assert queries.op12_token_alignment(spark, SF_SMALL).columns == list(NAMES)


def test_pieces_blocks_and_parts_do_not_matter(spark, documents, monkeypatch):
    rows = [(k, t, "en", "s") for k, t in enumerate(TEXTS)] + [(99, "the quick brown fox, jumps over it " * 700, "en", "s")]
    whole = align.align(documents(rows), A, B, keep_groups=True).collect()
    for name, value in (("PIECE", 16), ("BLOCK", 3), ("PART", 200), ("SPELL", 50), ("SLICE", 100)):
        monkeypatch.setattr(align, name, value)
    # the defaults of overlaps are bound when it is defined
    monkeypatch.setattr(align.overlaps, "__defaults__", (16, 3))
    assert sorted(align.align(documents(rows), A, B, keep_groups=True).collect(), key=str) == sorted(whole, key=str)
    for r in whole:
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.randoms(use_true_random=False),
       st.integers(1, 12), st.integers(1, 4))
def test_merge_path(sizes, rng, piece, block):
    total = sum(sizes)
    a = np.cumsum(sizes)
    b = np.array(sorted(rng.sample(range(1, total), rng.randint(0, total - 1))) + [total])
    links, together = [], []
    for x, y, last_a, last_b in align.overlaps(a, b, piece, block):
        links += list(zip(x.tolist(), y.tolist()))
        together += list(zip(last_a.tolist(), last_b.tolist()))
    begin_a, begin_b = np.append(0, a[:-1]), np.append(0, b[:-1])
    assert links == [(i, j) for i in range(len(a)) for j in range(len(b)) if begin_a[i] < b[j] and begin_b[j] < a[i]]
    assert together == [(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] == b[j]]


def test_pair_counts(spark, documents):
    docs = documents([(1, "red car", "en", "s"), (2, "red cars", "en", "s"), (3, "red red red", "en", "s")])
    table, bits = align.encoded(docs, A, B)
    got = {(r.a, r.b): (r.docs, r.best) for r in align.pair_counts(table, bits).collect()}
    brute, count = Brute(), Counter()
    for text in ("red car", "red cars", "red red red"):
        count.update(set(brute.links(text)[2]))
    assert {k: v[0] for k, v in got.items()} == dict(count)
    assert all(best == (n == max(c for (a, _), c in count.items() if a == k[0])) for k, (n, best) in got.items())


def test_odd_rows(spark, odd_documents):
    got = align.align(odd_documents, A, B)
    assert rows_of(got.select(*NAMES)) == Brute_short(odd_documents)
    assert align.align(odd_documents.limit(0), A, B).count() == 0


def Brute_short(docs):
    """The brute force is quadratic in a text: long texts get their links
    from a two-pointer walk."""
    brute = Brute()

    def walk(text):
        if not text or len(text) < 5_000:
            return Brute.links(brute, text)
        a, b = brute.a.encode(" " + text, add_special_tokens=False).ids, brute.b.encode(text)
        sa, sb = spans(a, brute.a_entry), spans(b, brute.b_entry)
        i = j = 0
        links, groups, own = [], [], ([], [])
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            ea, eb = sa[i][1], sb[j][1]
            if ea <= eb:
                own[0].append(str(a[i]))
                i += 1
            if eb <= ea:
                own[1].append(str(b[j]))
                j += 1
            if ea == eb:
                groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
                own = ([], [])
        return ";".join(groups), len(groups), links, len(a), len(b)

    brute.links = walk
    return brute.table([(r.doc_id, r.text) for r in docs.collect()])
