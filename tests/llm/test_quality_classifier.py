import numpy as np

from topicgrove.llm import quality_classifier as Q
from topicgrove.llm.registry import op4_quality_classifier


def brute(net, text):
    """The network by its definition, one window at a time."""
    size = Q.BLOCK * Q.STEP
    n = max(1, -(-len(text) // size))
    codes = list(text) + [Q.PAD] * (n * size - len(text)) + [Q.PAD] * Q.STEP
    peaks = np.array([
        np.max([np.concatenate([net.embedding[c] for c in codes[s : s + Q.WIDTH]]) @ net.filters + net.bias for s in range(b * size, (b + 1) * size, Q.STEP)], axis=0)
        for b in range(n)
    ])
    chunks = np.maximum([np.max(peaks[b : b + 2], axis=0) for b in range(n)], 0)
    x = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)]) @ net.output + net.offset[0]
    return 1 / (1 + np.exp(-x))


def test_scores_equal_the_definition(monkeypatch):
    monkeypatch.setattr(Q, "RUN_BLOCKS", 3)
    net = Q.fresh()._replace(bias=np.linspace(-0.2, 0.2, Q.FILTERS, dtype=np.float32))
    texts = [b"", b"a", b"abcd" * 31, b"x" * 128, b"y" * 129, bytes(range(256)) * 9, "é ü".encode() * 200]
    assert np.allclose(Q.predict(net, texts), [brute(net, t) for t in texts], atol=1e-5)


def test_gradients_equal_differences():
    texts, labels = [b"hello world " * 30, b"!!! ???" * 5, b""], np.array([1, 0, 1], np.float32)
    net = Q.fresh(3)
    loss = lambda n: float(-np.mean(np.log(np.where(labels == 1, p := Q.predict(n, texts), 1 - p))))
    for field, g in zip(net._fields, Q._gradients(net, texts, labels)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        up, down = [getattr(net, field).copy() for _ in range(2)]
        up[at] += 1e-2
        down[at] -= 1e-2
        assert abs((loss(net._replace(**{field: up})) - loss(net._replace(**{field: down}))) / 2e-2 - g[at]) < 0.02 + 0.1 * abs(g[at]), field


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = op4_quality_classifier(spark, sf_dir)
    rows = found.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    good, bad = rows[rows.quality == 1], rows[rows.quality == 0]
    assert (good.predicted == 1).mean() > 0.97 and (bad.predicted == 0).mean() > 0.85
    assert rows.score.between(0, 1).all()


def test_edge_rows(spark, documents):
    docs = documents([(1, None), (2, ""), (None, "text"), (4, "long " * 100_000), (4, "text")])
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    net = Q.fit(docs, labels)
    rows = Q.score(docs, net).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert Q.score(documents([]), Q.fit(documents([]), labels.where("false"))).count() == 0
    assert Q.score(docs, net, docs.columns).columns == [*docs.columns, "score", "predicted"]


def test_without_rows_of_a_class_every_text_stays(spark, documents):
    docs = documents([(i, f"text {i} " * i) for i in range(40)])
    for rows in ([], [(10**9, 1), (10**9 + 1, 0)], [(i, 0) for i in range(40)], [(i, 1) for i in range(40)]):
        net = Q.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert {(r.score, r.predicted) for r in Q.score(docs, net).collect()} == {(0.5, 1)}
