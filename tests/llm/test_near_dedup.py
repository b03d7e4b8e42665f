import random

import numpy as np
import pyarrow as pa
import pytest

from topicgrove.llm import near_dedup as N
from topicgrove.llm import graph as G
from topicgrove.llm.graph import components


def shingles(text, n):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], [[rng.choice(words) for _ in range(120)] for _ in range(8)]
    for i in range(160):  # copies at similarities around the threshold, and chains of them
        text = list(base[i % 8])
        if i % 5 == 0:
            base[i % 8] = text
        for _ in range(rng.randrange(0, 8)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "One  TWO"), (205, "one"), (206, "a b c d"), (207, "a b c e"), (208, "a b c d " * 500), (209, "a b c d " * 400)]
    return rows


@pytest.mark.parametrize("n, tile", [(4, 4096), (5, 5)])
def test_equals_brute_force(documents, monkeypatch, n, tile):
    monkeypatch.setattr(N, "TILE_NODES", tile)
    rows = corpus()
    expected = brute(rows, n, 80)
    found = N.near_duplicates(documents(rows), n=n).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_shingles, r.component_id) == expected[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)
    assert len({c for _, c in expected.values()}) < len(rows) - 20


def test_null_ids_and_repeats(documents):
    docs = documents([(5, "a b c d e"), (None, "A b c d e"), (None, "x y z"), (7, "q r s t u"), (7, "a b c d e"), (7, "q r s t u"), (9, "q r s t u")])
    found = sorted(((r.doc_id or 0, r.component_id or 0, r.kept) for r in N.near_duplicates(docs).collect()))
    assert found == [(0, 0, True), (0, 5, False), (5, 5, True), (7, 5, False), (7, 5, False), (7, 5, False), (9, 5, False)]
    assert N.near_duplicates(documents([])).count() == 0
    assert [r.kept for r in N.near_duplicates(documents([(1, None)])).collect()] == [True]


def test_odd_sketch_estimates():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    for similarity in (0.6, 0.8, 0.95):
        k = int(2000 * similarity / (1 + similarity))
        a, b = np.sort(pool[:1000]), np.sort(np.concatenate([pool[:k], pool[1000 : 2000 - k]]))
        x, y = (N.odd_sketches(N.minhash(s, np.array([0, len(s)])))[0] for s in (a, b))
        assert abs(N.estimated_similarity(np.bitwise_count(x ^ y).sum()) - similarity) < 0.12


def test_shingles_of_a_batch():
    texts = ["a b c d e", "", "a b", "A b c d", "x " * 50]
    _, starts = N.shingle_hashes(pa.array(texts, pa.large_string()), 4)
    assert np.diff(starts).tolist() == [len(shingles(t, 4)) for t in texts]


@pytest.mark.parametrize("chunk", [1_000_000, 20])
def test_components_of_a_long_path(spark, monkeypatch, chunk):
    monkeypatch.setattr(G, "CHUNK_LINKS", chunk)
    path = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    labels = {r.node: r.label for r in components(path).collect()}
    assert labels == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components(path.where("false")).count() == 0


def test_contracted_links():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = rng.integers(1, 30)
        a, b = rng.integers(0, n, (2, rng.integers(0, 2 * n)))
        parent = list(range(n))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for x, y in zip(a, b):
            lo, hi = sorted((root(x), root(y)))
            parent[hi] = lo
        node, top = G.contracted(a, b)
        expected = {i: root(i) for i in set(a.tolist()) | set(b.tolist())}
        assert dict(zip(node.tolist(), top.tolist())) == {i: r for i, r in expected.items() if i != r}


def test_buckets_propose_only_pairs_that_sketches_allow():
    rng = np.random.default_rng(3)
    notice = rng.integers(0, 1 << 62, 200).astype(np.uint64)  # texts with this in common are similar by a third: near-duplicates are not
    sets = [np.unique(np.concatenate([notice, rng.integers(0, 1 << 62, 200).astype(np.uint64)])) for _ in range(300)]
    sets[7] = np.unique(np.concatenate([sets[5][:380], notice[:5]]))
    starts = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    sketch = N.odd_sketches(N.minhash(np.concatenate(sets), starts))
    nodes = np.arange(300)
    sizes = np.diff(starts)
    assert N.bucket_links(nodes, nodes, sizes, sketch, 80) in (([5], [7]), ([7], [5]))
    same = np.where(nodes == 7, 5, nodes)  # confirmed already
    assert N.bucket_links(nodes, same, sizes, sketch, 80) == ([], [])
    assert N.bucket_links(nodes, np.zeros(300, int), sizes, sketch, 80) == ([], [])


@pytest.mark.parametrize("limits", [{"TILE_NODES": 5, "BUCKET_NODES": 4}, {"TILE_BYTES": 4000}])
def test_cut_buckets_and_groups(documents, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(N, name, value)
    rows = corpus()
    expected = brute(rows, 5, 80)
    for r in N.near_duplicates(documents(rows)).collect():
        assert (r.n_shingles, r.component_id) == expected[r.doc_id]


def test_repeated_rows_are_one_set(documents):
    near = [("a b c d e f g h i j k l m n o p q r s t u v w x y z").replace("z", f"z{i}") for i in range(3)]
    docs = documents([(4, near[0])] * 300 + [(5, near[1]), (4, "other words are here too"), (6, near[2])]).repartition(5)
    rows = N.sketches(docs, 5).cache()
    keys = rows.select("doc_id", "text_hash").distinct()
    found = N.full_sets(N.texts_once(docs, rows, keys), 5).select("node", "text_hash").collect()
    assert len(found) == len(set(found)) == 4
    assert {(r.doc_id, r.component_id) for r in N.near_duplicates(docs).collect()} == {(4, 4), (5, 4), (6, 4)}
