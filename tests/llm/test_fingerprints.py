import hashlib
import math
import random
from collections import Counter

import pytest
from conftest import SF_SMALL

from tickstat.llm import fingerprints as FP
from tickstat.llm import queries


def of(text):
    return FP.to_string(*FP.vector(text))


def test_order_does_not_matter_and_paragraphs_add_up():
    rng = random.Random(4)
    lines = ["".join(rng.choices("abc é", k=rng.randint(0, 40))) for _ in range(30)]
    whole = of("\n".join(lines))
    rng.shuffle(lines)
    assert of("\n".join(lines)) == whole
    assert FP.combine(of("\n".join(lines[:11])), of("\n".join(lines[11:]))) == whole
    assert FP.combine(whole, of(lines[5]), -1) == of("\n".join(lines[:5] + lines[6:]))
    assert of("a\nb") != of("a\nb\nb") and of("") == of("\n\n")


def test_slices_do_not_change_the_vector(monkeypatch):
    text = "".join(random.Random(2).choices("abcdef \n", k=3000))
    whole = of(text)
    monkeypatch.setattr(FP, "SLICE", 97)
    assert of(text) == whole


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))


def brute(rows):
    rows = ordered(rows)
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        edited = t[:len(t) - cut] + nxt[:cut]
        a, b = FP.vector(t), FP.vector(edited)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), FP.to_string(*a), FP.to_string(*b),
                    FP.likeness(a, b), FP.likeness(a, FP.vector(nxt))))
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op9_fingerprints(spark, SF_SMALL).collect()]
    assert sorted(got, key=repr) == brute(rows)
    near = sorted(r[5] for r in got if r[1] > 400)
    assert near[len(near) // 10] > 0.5                # three quarters of the text are the same


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_odd_rows(odd_documents, ranges):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = [tuple(r) for r in FP.with_edited(odd_documents, ranges).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert FP.with_edited(odd_documents.limit(0), ranges).count() == 0


def test_one_row_is_its_own_successor(documents):
    got = FP.with_edited(documents([(7, "abcdefgh", "en", "s")])).collect()
    assert len(got) == 1 and got[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert got[0].near_next == 1.0


def test_large_ids_keep_their_order(documents):
    base = 2**62
    rows = [(base + k, f"text {k} " * 9, "en", "s") for k in range(50)]
    got = [tuple(r) for r in FP.with_edited(documents(rows), 8).collect()]
    assert sorted(got, key=repr) == brute([r[:2] for r in rows])


def exact_likeness(a, b):
    """Of texts of one repeated window pattern each, by unbounded counts of
    every lane, worked out in plain Python from the windows themselves."""
    def lanes(text):
        windows = Counter(p[i:i + FP.WINDOW] for p in text.encode().split(b"\n") for i in range(len(p) - FP.WINDOW + 1))
        out = [0] * FP.SKETCH
        for w, n in windows.items():
            h = 0
            for c in w:
                h = (h * FP.BASE + c + 1) % 2**64
            b = (h * int(FP.MIX) % 2**64) >> (64 - (2 * FP.SKETCH - 1).bit_length())
            out[b // 2] += -n if b % 2 else n
        return out
    x, y = lanes(a), lanes(b)
    dot = sum(p * q for p, q in zip(x, y))
    return max(0.0, dot / math.sqrt(sum(p * p for p in x) * sum(q * q for q in y)))


@pytest.mark.parametrize("unit,times", [("the same phrase of 35 characters, x ", 40_000), ("a", 40_000), ("a", 120_000),
                                        ("a line that recurs\n", 150_000)])
def test_likeness_of_long_repetitive_texts(unit, times):
    text = unit * times
    cut = len(text) // 4
    edited = text[:-cut] + "".join(random.Random(3).choices("abcdef gh", k=cut))
    a, b = FP.vector(text), FP.vector(edited)
    assert FP.likeness(a, b) == pytest.approx(exact_likeness(text, edited)) and FP.likeness(a, b) > 0.9
    again = [FP.from_string(FP.to_string(*v)) for v in (a, b)]
    assert FP.likeness(*again) == FP.likeness(a, b)
    assert FP.combine(FP.combine(of(text), of(edited)), of(text), -1) == of(edited)


def test_short_paragraphs_count_in_the_likeness(monkeypatch):
    rng = random.Random(9)
    for text in ("\n".join(str(rng.randrange(10**6)) for _ in range(5000)),
                 "\n".join("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(2)) for _ in range(5000))):
        lines = text.split("\n")
        edited = "\n".join(lines[:3750] + [x[::-1] + "x" for x in lines[3750:]])
        assert 0.6 < FP.likeness(FP.vector(text), FP.vector(edited)) < 0.9
    for short in ("a", "ab", "abcdefg", "é", "\n\nx\n"):
        assert FP.vector(short)[1].any()
    # the padding is not a byte of the text, and slices do not matter
    assert of("ab\nc") == of("c\nab") and (FP.vector("a")[1] != FP.vector("a\0")[1]).any()
    whole = of(text)
    monkeypatch.setattr(FP, "SLICE", 97)
    assert of(text) == whole
