import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from conftest import SF_SMALL

from tickstat.llm import manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return sha("".join(map(field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def parents(nodes):
    return [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]


def path_of(nodes, i):
    """(others before, others after) of every run up to the root; the root."""
    out = []
    while len(nodes) > 1:
        start = i // 8 * 8
        out.append((nodes[start:i], nodes[i + 1:start + 8]))
        nodes, i = parents(nodes), i // 8
    return out, nodes[0]


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), r))
    for g in groups.values():
        g.sort(key=lambda x: x[:3])
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subroots = [path_of([x[2] for x in groups[g]], 0)[1] for g in order]
    out = []
    for k, g in enumerate(order):
        upper, root = path_of(subroots, k)
        leaves = [x[2] for x in groups[g]]
        for i, (_, _, leaf, r) in enumerate(groups[g]):
            path = path_of(leaves, i)[0] + upper
            node = leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = r["text"]
                node = leaf_of(r, None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for before, after in path:
                node = sha("".join(before) + node + "".join(after))
            proof = sha("".join("".join(a) + "".join(b) for a, b in path))
            out.append((r["doc_id"], leaf, subroots[k], root, proof, node, node == root))
    return sorted(out, key=str)


def got(docs):
    rows = manifest.build(docs, manifest.tampered()).proofs().collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.folded_root == r.root)
                   for r in rows), key=str)


def test_query_equals_brute_force(spark):
    from tickstat.llm import queries
    rows = [r.asDict() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    found = sorted((tuple(r) for r in queries.op11_manifest(spark, SF_SMALL).collect()), key=str)
    assert found == brute(rows)
    assert {r[6] for r in found} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (8, 9), (64, 65, 1), (7, 8, 9, 63, 2, 1, 1, 1, 1, 600), (4096, 4097, 3)])
def test_every_shape_of_tree(spark, documents, sizes):
    rng = random.Random(len(sizes))
    rows = [(g * 50_000 + i * rng.choice((1, 3)) + 7 * i, f"Text {g} {i}" if i % 5 else "low", f"l{g}", "s")
            for g, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    docs = documents(rows)
    assert got(docs) == brute([r.asDict() for r in docs.collect()])


def test_arrays_of_two_shuffles(spark, documents, monkeypatch):
    """Arrays of 8 leaves: several tables of nodes in both trees."""
    monkeypatch.setattr(manifest, "DEPTH", 1)
    monkeypatch.setattr(manifest, "SPAN_BITS", 3)
    docs = documents([(i * 1_000_003 - 5, f"T{i}", f"l{i % 11}", None) for i in range(700)])
    assert got(docs) == brute([r.asDict() for r in docs.collect()])


def test_odd_rows(spark, odd_documents, documents):
    assert got(odd_documents) == brute([r.asDict() for r in odd_documents.collect()])
    assert got(odd_documents.limit(0)) == []
    far = documents([(-(2**63), "A", "x", "s"), (2**63 - 1, "B", "x", "s"), (-1, "C", "x", "s"), (0, "D", "x", "s"),
                     (None, "E", "x", "s"), (None, "F", "x", "s"), (32_768, "G", "x", "s"), (32_767, "H", "x", "s")])
    assert got(far) == brute([r.asDict() for r in far.collect()])


def test_groups(spark, documents):
    docs = documents([(1, "a", None, "s"), (2, "b", "en", "s"), (3, "c", "de", "s")])
    rows = {r.group: (r.subroot, r.root) for r in manifest.build(docs).groups().collect()}
    assert set(rows) == {None, "en", "de"} and len({r for _, r in rows.values()}) == 1
    assert rows[None][1] == sha(rows[None][0] + rows["de"][0] + rows["en"][0])
