import random

import pytest
from conftest import SF_SMALL

from tickstat.llm import line_dedup as L
from tickstat.llm import queries
from tickstat.llm.common import row_key


def lines_of(text):
    return [x.encode().strip() for x in (text or "").split("\n") if x.encode().strip()]


def brute(rows, min_words):
    """Lines kept of each row: a line goes if it is in a stretch of consecutive
    lines of at least min_words words that an earlier document has too."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    lines = [lines_of(text) for _, text, _ in rows]
    known = [set(x) for x in lines]
    out = []
    for d, (i, _, key) in enumerate(rows):
        own, gone = lines[d], set()
        for e in range(d):
            if rows[e][2] == key or not known[e] & known[d]:
                continue
            other = lines[e]
            for shift in range(-len(other) + 1, len(own)):             # diagonals of the two
                block = []
                for j in range(max(0, shift), min(len(own), len(other) + shift) + 1):
                    if j < len(own) and j - shift < len(other) and own[j] == other[j - shift]:
                        block.append(j)
                        continue
                    if sum(len(own[k].split()) for k in block) >= min_words:
                        gone.update(block)
                    block = []
                if sum(len(own[k].split()) for k in block) >= min_words:
                    gone.update(block)
        out.append((i, [x.decode() for k, x in enumerate(own) if k not in gone]))
    return sorted(out, key=repr)


def kept(df, min_words):
    got = L.dedup(df, min_words).collect()
    return sorted(((r.doc_id, [x.decode() for x in lines_of(r.text)]) for r in got), key=repr)


def keyed(df):
    return [tuple(r) for r in df.select("doc_id", "text", row_key()).collect()]


def test_query_equals_brute_force(spark):
    rows = keyed(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got = queries.op5_line_dedup(spark, SF_SMALL).collect()
    assert sorted(((r.doc_id, [x.decode() for x in lines_of(r.text)]) for r in got), key=repr) == brute(rows, L.MIN_WORDS)
    assert sum(r.n_removed > 0 for r in got) > 5
    assert all(r.partners for r in got if r.n_removed)


@pytest.mark.parametrize("seed", range(3))
def test_random_documents(spark, documents, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 4))) for _ in range(12)]
    rows = [(rng.randint(0, 30), "\n".join(rng.choice([*pool, "", " "]) for _ in range(rng.randint(0, 25))), "en", "s")
            for _ in range(40)]
    docs = documents(rows)
    assert kept(docs, 6) == brute(keyed(docs), 6)


def test_passages_and_clean_documents(spark, documents):
    passage = "\n".join(" ".join(f"p{k}x{w}" for w in range(18)) for k in range(3))
    rows = [(k, f"own line number {k} of it\n{passage}\ntail {k}", "en", "s") for k in range(200)]
    rows += [(1000 + k, "\n".join(f"clean {k} {j} " + "word " * 30 + f"{k}{j}" for j in range(5)), "en", "s")
             for k in range(20)]
    got = {r.doc_id: r for r in L.dedup(documents(rows)).collect()}
    assert got[0]._n_removed == 0 and passage in got[0].text
    for k in range(1, 200):
        assert got[k].text == f"own line number {k} of it\ntail {k}" and got[k]._partners == [0]
    assert all(got[1000 + k]._n_removed == 0 and got[1000 + k].text == rows[200 + k][1] for k in range(20))


def test_moved_blocks_go_too(documents):
    a, b = ("\n".join(" ".join(f"{x}{k}{w}" for w in range(12)) for k in range(2)) for x in "ab")
    got = {r.doc_id: r.text for r in L.dedup(documents([(1, f"{a}\n{b}", "", ""), (2, f"new\n{b}\nmid\n{a}", "", "")])).collect()}
    assert got == {1: f"{a}\n{b}", 2: "new\nmid"}


def test_odd_rows(spark, odd_documents):
    before = odd_documents.collect()
    got = L.dedup(odd_documents).collect()
    assert sorted((repr(r.doc_id), r.text or "", r.n_words) for r in got) == \
        sorted((repr(r.doc_id), r.text or "", r.n_words) for r in before)
    assert sum(r.text is None for r in got) == 2
    assert L.dedup(odd_documents.limit(0)).count() == 0
    copies = odd_documents.where("doc_id = 4").union(odd_documents.where("doc_id = 4"))
    assert all(r._n_removed == 0 for r in L.dedup(copies).collect())    # repeated rows: one document


def test_stretches_of_a_list():
    rng = random.Random(5)
    for _ in range(300):
        values = [rng.choice((-(2**63), -1, 0, 1, 2**63 - 1, 7)) for _ in range(rng.randint(0, 30))]
        n = rng.randint(1, 6)
        known = {tuple(values[i:i + n]) for i in range(len(values) - n + 1)}
        own = L.stretches(values, n)
        for _ in range(40):
            run = tuple(rng.choice((-(2**63), -1, 0, 1, 2**63 - 1, 7)) for _ in range(n))
            assert (run in own) == (run in known)
        assert all(run in own for run in known)


def test_long_documents_with_a_separator():
    """24,001 lines, every second one the same: linear, not all places of a
    line for every run of it."""
    import time
    a = [x for i in range(12_000) for x in (0, 10**6 + i)] + [0]
    b = [x for i in range(12_000) for x in (0, 2 * 10**6 + i)] + [0]
    words = [1] * len(b)
    start = time.process_time()
    assert L.common_lines(a, b, words, 20) == set()
    moved = b[:9_000] + a[3_001:3_101] + b[9_000:] + a[201:301]
    assert L.common_lines(a, moved, [1] * len(moved), 20) >= {*range(9_000, 9_100), *range(len(moved) - 100, len(moved))}
    assert time.process_time() - start < 10
