"""The pipeline's stages, each judged on its own input."""

import base64
import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from conftest import SF_SMALL
from .test_line_dedup import brute as brute_lines
from .test_line_dedup import lines_of
from .test_mixing import brute_targets, size_of
from .test_native import brute_base
from .test_simhash import brute_fingerprint, brute_groups

import corpus_pipeline as C
from tickstat.llm.common import row_key
from tickstat.llm.line_dedup import MIN_WORDS


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Input and result of every stage at the smallest scale."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    out.append(docs)
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def test_columns_are_kept(tables):
    assert all(t.dtypes == tables[0].dtypes for t in tables[1:5])


def test_quality_stage(tables):
    before, after = (t.collect() for t in tables[:2])
    assert set(after) <= set(before)
    gone = set(before) - set(after)
    failed = {r for r in before if brute_base(r.text)[5]}
    assert failed <= gone and len(gone - failed) < len(before) / 4


def test_line_stage(tables):
    rows = [tuple(r) for r in tables[1].select("doc_id", "text", row_key()).collect()]
    want = [(i, kept) for i, kept in brute_lines(rows, MIN_WORDS) if kept]
    got = tables[2].collect()
    assert sorted(((r.doc_id, [x.decode() for x in lines_of(r.text)]) for r in got), key=repr) == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_near_duplicate_stage(tables):
    before = tables[2].collect()
    pairs = [(r.doc_id, brute_fingerprint(r.text)) for r in before]
    assert sorted(r.doc_id for r in tables[3].collect()) == sorted(set(brute_groups(pairs, 2)))


def test_near_duplicates_of_copies(spark, documents):
    text = " ".join(f"w{k}" for k in range(300))
    rows = [(5, text, "en", "a"), (9, text, "en", "b"), (2, text + " more", "en", "a"), (2, text + " more", "en", "a"),
            (7, "something else entirely here", "en", "a"), (None, text, None, None), (8, None, None, None), (3, "", "", "")]
    got = C.near_duplicates(spark, documents(rows), SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == [2, 3, 7] and got[0].n_words == "x"


def test_mixing_stage(tables):
    before, after = (t.collect() for t in tables[3:5])
    copies = Counter(after)
    assert set(copies) <= set(before) and max(copies.values()) <= 3
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += size_of(r.text)
    for r, n in copies.items():
        taken[r.source] += n * size_of(r.text)
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), rel=0.2)
    targets = brute_targets(sizes)
    big = sorted(targets, key=targets.get)[-3:]
    assert all(0.4 * targets[s] < taken[s] < 1.6 * targets[s] for s in big)


def test_encoding_stage(tables):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in tables[4].collect():
        ids = library.encode_ordinary(r.text)
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(r.text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, tables[5].collect())) == want


def test_run_equals_the_stages(spark, tables):
    assert Counter(map(tuple, C.run(spark, SF_SMALL).collect())) == Counter(map(tuple, tables[5].collect()))


def test_odd_rows_pass_every_stage(spark, odd_documents):
    for docs in (odd_documents, odd_documents.limit(0)):
        for _, stage in C.STAGES:
            got = stage(spark, docs, SF_SMALL)
            got.collect()
            if stage is not C.encode:
                assert got.columns == docs.columns
