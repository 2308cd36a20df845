import random

import numpy as np
import pytest
from conftest import SF_SMALL

from tickstat.llm import jaccard, queries


def brute_set(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute(rows, percent=80, width=5):
    """(id, size, smallest id reachable), comparing every pair."""
    sets = [brute_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    lowest = {}
    for i, (own, _) in enumerate(rows):
        r = find(i)
        lowest[r] = min((x for x in (lowest.get(r), own) if x is not None), default=None)
    return sorted(((own, len(s), lowest[find(i)]) for i, ((own, _), s) in enumerate(zip(rows, sets))), key=str)


def got(docs, **options):
    found = jaccard.near_documents(docs, **options).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)


def edited(rng, words, share, vocabulary):
    words = list(words)
    for _ in range(round(share * len(words))):
        at, what = rng.randrange(len(words)), rng.random()
        if what < 0.4:
            words[at] = rng.choice(vocabulary)
        elif what < 0.7:
            words.insert(at, rng.choice(vocabulary))
        elif len(words) > 1:
            del words[at]
    return words


def corpus(seed, centres, copies, longest, share, passage=()):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(centres):
        words = rng.choices(vocabulary, k=rng.randint(1, longest))
        for _ in range(rng.randint(1, copies)):
            own = edited(rng, words, rng.random() * share, vocabulary)
            at = rng.randrange(len(own) + 1)
            rows.append(" ".join(own[:at] + list(passage) + own[at:]))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op13_jaccard_join(spark, SF_SMALL).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("seed,centres,copies,longest,share,percent", [
    (1, 60, 6, 12, 0.2, 80), (2, 40, 8, 120, 0.06, 80), (3, 25, 6, 400, 0.04, 80), (4, 40, 6, 60, 0.15, 50),
    (5, 40, 6, 40, 0.02, 95), (6, 30, 5, 30, 0.05, 100), (7, 10, 5, 4600, 0.03, 80)])
def test_random_corpora(spark, documents, seed, centres, copies, longest, share, percent):
    rows = corpus(seed, centres, copies, longest, share)
    docs = documents([(i, t, "en", "s") for i, t in rows])
    assert got(docs, percent=percent) == brute(rows, percent)


@pytest.mark.parametrize("bucket", [1, 3])
def test_large_groups_and_shared_passages(spark, documents, monkeypatch, bucket):
    """Every key counts as a large one: stars, rarest shingles and the last
    comparison have to find what pairing up would."""
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    passage = [f"p{i}" for i in range(60)]
    rows = corpus(7, 40, 12, 90, 0.08, passage)
    rows += [(len(rows) + i, t) for i, (_, t) in enumerate(corpus(8, 20, 8, 50, 0.05))]
    docs = documents([(i, t, "en", "s") for i, t in rows])
    assert got(docs) == brute(rows)


def test_chain_of_sets(spark, documents, monkeypatch):
    """Neighbours are linked, the ends are not; one component."""
    monkeypatch.setattr(jaccard, "BUCKET", 2)
    words = [f"c{i}" for i in range(400)]
    rows = [(100 - k, " ".join(words[4 * k:4 * k + 80])) for k in range(60)]
    docs = documents([(i, t, "en", "s") for i, t in rows])
    assert got(docs) == brute(rows)


def test_links_between_bands(spark, documents):
    """Sets on both sides of a power of two have sketches of different widths."""
    words = [f"b{i}" for i in range(2_200)]
    rows = [(1, " ".join(words[:1_010])), (2, " ".join(words[:1_060])), (3, " ".join(words[50:2_030])),
            (4, " ".join(words[:2_100]))]
    assert got(documents([(i, t, "en", "s") for i, t in rows])) == brute(rows) == [
        (1, 1_006, 1), (2, 1_056, 1), (3, 1_976, 3), (4, 2_096, 3)]


def test_sets_without_a_shared_word_meet_through_shingles():
    """Of two linked sets some key agrees, whatever the hashes are: random
    sets whose shingles all fall into few words."""
    rng = np.random.default_rng(3)
    for n in (4, 5, 9, 15, 16, 40, 63, 64, 100):
        for crowded in (False, True):
            for _ in range(60):
                top = 1 << (59 if crowded else 64)
                own = np.unique(rng.integers(0, top, 2 * n, np.uint64, endpoint=False))
                rng.shuffle(own)
                a = own[:n]
                differ = rng.integers(0, max(1, n // 5 + 1))
                b = np.concatenate([a[differ // 2:], own[n:n + differ - differ // 2]])
                both = len(np.intersect1d(a, b))
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    keys = [np.concatenate([x["words"][:x["need"]] for x in jaccard.set_lists(np.sort(s), 80)])
                            for s in (a, b)]
                    assert np.intersect1d(*keys).size


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(4)
    for n, m in ((1, 0), (10, 3), (500, 160), (5_000, 1_600), (1_010, 40), (4_090, 90), (2_040, 60)):
        a = np.unique(rng.integers(0, 1 << 64, n, np.uint64, endpoint=False))
        b = np.unique(np.concatenate([a[m // 4:], rng.integers(0, 1 << 64, m, np.uint64, endpoint=False)]))
        one, two = sorted((jaccard.parity_sketch(a), jaccard.parity_sketch(b)), key=len)
        if len(one) < len(two):                            # of the next band
            assert len(two) == 2 * len(one)
            two = np.bitwise_xor.reduce(np.array(two).reshape(2, -1)).tolist()
        distance = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(one, two))
        assert distance <= len(np.setxor1d(a, b))


def test_equal_sets_list_their_keys_once(spark, documents):
    """What is dealt out does not grow with copies; every set is still found."""
    texts = [" ".join(f"t{i}-{k}" for k in range(60)) for i in range(5)] + [None, ""]
    one, many = (documents([(i, t, "en", "s") for i, t in enumerate(texts * n)]) for n in (1, 30))
    counts = []
    for docs in (one, many):
        table = jaccard.write_once(jaccard.described(docs, 5, 80), "test-sets")
        counts.append(jaccard.keys_of(table, jaccard.one_row_each(table)).count())
        members = jaccard.members_of(table, jaccard.one_row_each(table))
        assert members.count() == members.distinct().count() == 0
    assert counts[0] == counts[1] > 0
    assert got(many) == brute([(r.doc_id, r.text) for r in many.collect()])


def test_odd_rows(spark, odd_documents, documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert got(odd_documents) == brute(rows)
    assert got(odd_documents.limit(0)) == []
    assert got(documents([(1, None, "en", "s"), (2, "  ", "en", "s")])) == [(1, 0, 1), (2, 0, 2)]
    with pytest.raises(ValueError):
        jaccard.near_documents(odd_documents, percent=0)
