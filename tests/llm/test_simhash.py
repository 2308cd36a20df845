import random

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL

from tickstat.llm import queries, simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(pairs, max_bits):
    """Smallest id reachable, for every (id, fingerprint)."""
    best = [i for i, _ in pairs]
    changed = True
    while changed:
        changed = False
        for k, (_, f) in enumerate(pairs):
            low = min(best[j] for j, (_, g) in enumerate(pairs) if (f ^ g).bit_count() <= max_bits)
            if low < best[k]:
                best[k], changed = low, True
    return best


def test_query_equals_brute_force(spark):
    rows = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in queries.op10_simhash(spark, SF_SMALL).collect()}
    groups = brute_groups(fps, 2)
    assert got == {i: (f, g) for (i, f), g in zip(fps, groups)}


def clustered(seed, n, spread):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = []
    for i in range(n):
        f = rng.choice(centres)
        for _ in range(rng.randint(0, spread)):
            f ^= 1 << rng.randrange(64)
        out.append((i, f - (1 << 64) if f >> 63 else f))
    return out


@pytest.mark.parametrize("max_bits,bucket", [(2, 64), (2, 2), (1, 2), (3, 2), (3, 64), (0, 2)])
def test_search_finds_every_link(spark, max_bits, bucket):
    fps = clustered(max_bits, 120, 4)
    got = simhash.near_groups(spark.createDataFrame(fps, "doc_id long, fp long"), max_bits, bucket).collect()
    groups = {r.fp: r.group_id for r in got}
    unsigned = [(i, f & (1 << 64) - 1) for i, f in fps]
    assert [groups[f] for _, f in fps] == brute_groups(unsigned, max_bits)


def test_links_under_every_plan(spark):
    fps = clustered(9, 100, 3)
    reps = spark.createDataFrame(fps, "doc_id long, fp long").groupBy("fp").min("doc_id").select("fp")
    low, high = list(range(32)), list(range(32, 64))
    values = [r.fp & (1 << 64) - 1 for r in reps.collect()]
    want = {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2}
    for plan in ([(low, 1), (high, 0)], [(low, 0), (high, 1)], [(low + high, 2)]):
        got = simhash.candidate_links(reps, plan, 2, bucket=10_000).collect()
        found = {tuple(sorted((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1))) for r in got}
        assert found == want


def test_plan_spends_the_threshold():
    both = np.full((64, 64), 250)
    np.fill_diagonal(both, 500)
    for n in (10, 10**6, 10**10):
        plan = simhash.choose_plan(1000, both, 2) if n == 10 else simhash.choose_plan(n, both * (n // 1000), 2)
        assert sum(t + 1 for _, t in plan) == 3
        assert len({b for bits, _ in plan for b in bits}) == sum(len(bits) for bits, _ in plan)


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (2000, 64))
    bits[:, 40] = bits[:, 3]
    groups = simhash.group_bits(2000, bits.T @ bits, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any(3 in g and 40 in g for g in groups)


def test_odd_rows(spark, odd_documents):
    got = simhash.near_duplicates(odd_documents).collect()
    assert len(got) == odd_documents.count()
    empty = [r for r in got if r.fp == 0]
    assert len(empty) == 4 and {r.group_id for r in empty} == {1}      # two NULL, one empty, one blank text
    assert {r.fp for r in got} == {f - (1 << 64) if (f := brute_fingerprint(r.text)) >> 63 else f
                                   for r in odd_documents.collect()}
    assert simhash.near_duplicates(odd_documents.limit(0)).count() == 0
