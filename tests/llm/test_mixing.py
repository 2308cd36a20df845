from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL

from tickstat.llm import mixing, queries


def size_of(text):
    return len((text or "").encode().split())


def brute_targets(sizes):
    """{source: target} by sharing in turn."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, free, out = sum(sizes.values()), set(order), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        out |= {s: 3 * sizes[s] for s in over} if over else share
        left -= sum(out[s] for s in over)
        free = free - over if over else set()
    return out


def check_mix(rows, got, tolerance):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size_of(text)
    targets = brute_targets(sizes)
    by_id = {}
    for i, text, source in rows:
        by_id.setdefault(i, []).append((size_of(text), sizes[source]))
    taken = Counter()
    for r in got:
        assert (r.size, r.source_size) in by_id[r.doc_id] and 0 <= r.taken <= 3 * r.size
        source = next(s for i, t, s in rows if i == r.doc_id and (size_of(t), sizes[s]) == (r.size, r.source_size))
        assert r.target == pytest.approx(targets[source])
        taken[source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= tolerance
    return taken


def test_query_meets_the_targets(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    got = queries.op8_mixing(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    check_mix(rows, got, 2 * mixing.BLOCK_WORDS)
    again = queries.op8_mixing(spark, SF_SMALL).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_result_does_not_depend_on_the_partitions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    one = mixing.mix(docs.coalesce(1))["documents"].select("doc_id", "taken").collect()
    many = mixing.mix(docs.repartition(7, "n_chars"))["documents"].select("doc_id", "taken").collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, many))


def test_targets_are_reshared():
    assert mixing.share_out([10, 1000, 1000], [5.0, 2.0, 1.0], 3) == pytest.approx([30, 1320, 660])
    assert mixing.share_out([0, 0], [5.0, 2.0], 3) == [0.0, 0.0]
    assert mixing.share_out([], [], 3) == []


def test_odd_rows(spark, odd_documents):
    rows = [(r.doc_id, r.text, r.source) for r in odd_documents.collect()]
    got = mixing.mix(odd_documents)["documents"].collect()
    assert len(got) == len(rows)
    check_mix(rows, got, 2 * mixing.BLOCK_WORDS)
    assert all(r.taken == 0 for r in got if r["size"] == 0)
    assert mixing.mix(odd_documents.limit(0))["documents"].count() == 0
    with pytest.raises(ValueError):
        mixing.mix(odd_documents, max_sources=2)


def test_slices_do_not_change_the_result(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    whole = mixing.mix(docs)["documents"].select("doc_id", "taken").collect()
    assert whole
    monkeypatch.setattr(mixing, "SLICE_DOCS", 20)
    parts = mixing.mix(docs)
    assert parts["parts"].groupBy("number", "block").sum("words").where(f"`sum(words)` > {mixing.BLOCK_WORDS}").count() == 0
    sums = parts["parts"].groupBy("row").sum("words").join(parts["documents"], "row").where("`sum(words)` <> size")
    assert sums.count() == 0


def test_plan_fills_every_slot(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 64)
    parts = mixing.mix(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    plan = parts["plan"].collect()
    assert len({(r.shard, r.slot) for r in plan}) == len(plan)
    shards = Counter(r.shard for r in plan)
    assert set(shards.values()) - {shards[max(shards)]} <= {64}
    uses = Counter((r.number, r.block) for r in plan)
    assert max(uses.values()) <= 3
    for number in {r.number for r in plan}:
        own = [n for (k, _), n in uses.items() if k == number]
        assert max(own) - min(own) <= 1
    # the source counts of a shard vary as draws do
    counts = [Counter(r.number for r in plan if r.shard == s)[1] for s in list(shards)[:-1]]
    assert len(set(counts)) > 1


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutations(n):
    seen = [tuple(mixing.permute(np.arange(n), n, key).tolist()) for key in range(4)]
    assert all(sorted(p) == list(range(n)) for p in seen)
    assert n < 7 or len(set(seen)) == 4


def test_draws_use_up_the_quotas():
    quotas = np.array([1000, 0, 37, 5000, 0])
    seen = []
    for shard in range(-(-int(quotas.sum()) // mixing.SHARD_SLOTS)):
        number, j = mixing.shard_draw(shard, quotas, 5)
        seen += list(zip(number.tolist(), j.tolist()))
    assert sorted(seen) == [(s, j) for s, n in enumerate(quotas.tolist()) for j in range(n)]


def test_draws_of_huge_mixes():
    """The same draw at any size: a shard in the middle of 10**17 slots."""
    quotas = np.array([3 * 10**16, 6 * 10**16, 10**16, 5])
    number, j = mixing.shard_draw(10**13, quotas, 8)
    counts = np.bincount(number, minlength=4)
    assert counts.sum() == mixing.SHARD_SLOTS and (j >= 0).all() and (j < quotas[number]).all()
    assert len(set(zip(number.tolist(), j.tolist()))) == mixing.SHARD_SLOTS
    want = mixing.SHARD_SLOTS * (quotas / quotas.sum())
    assert (np.abs(counts - want) <= 6 * np.sqrt(want + 1)).all()


def brute_permutation(n, key):
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, full = (1 << half) - 1, (1 << 64) - 1

    def once(x):
        left, right = x >> half, x & mask
        for r in range(4):
            h = (right + (key * 4 + r + 1) * 0x9E3779B97F4A7C15) & full
            h = h * 0xBF58476D1CE4E5B9 & full
            h = (h ^ h >> 29) * 0x94D049BB133111EB & full
            left, right = right, left ^ (h >> 32 & mask)
        return left << half | right

    def walk(x):
        x = once(x)
        while x >= n:
            x = once(x)
        return x

    return walk


def brute_taken(documents):
    """Words taken of every row: documents packed one behind the other, slots
    permuted one by one."""
    order = sorted({d.source for d in documents}, key=lambda s: (s is None, s or ""))
    words, quotas = [], []
    for source in order:
        stream = [d.row for d in sorted((d for d in documents if d.source == source and d["size"]),
                                        key=lambda d: (d.place, d.row)) for _ in range(d["size"])]
        words.append([stream[i:i + mixing.BLOCK_WORDS] for i in range(0, len(stream), mixing.BLOCK_WORDS)])
        target = next(d.target for d in documents if d.source == source)
        n = len(words[-1])
        quotas.append(min(round(target / len(stream) * n), 3 * n) if n else 0)
    owners = [(s, j) for s, n in enumerate(quotas) for j in range(n)]
    place, taken = brute_permutation(len(owners), mixing.SEED), Counter()
    for slot in range(len(owners)):
        s, j = owners[place(slot)]
        n = len(words[s])
        key = (mixing.SEED * 1_000_003 + s) * 1_009 + j // n
        taken.update(words[s][brute_permutation(n, key)(j % n)])
    return taken


def test_taken_words_equal_brute_force(spark, odd_documents):
    small = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) < 4000")
    for docs in (small, odd_documents):
        documents = mixing.mix(docs)["documents"].collect()
        taken = brute_taken(documents)
        assert {d.row: d.taken for d in documents} == {d.row: taken[d.row] for d in documents}
