import numpy as np
import pyarrow as pa

from topicgrove.llm import toxicity as X
from topicgrove.llm.registry import op9_toxicity


def test_scores_equal_the_definition():
    model = X.Classifier({"idiot": 2.0, "idio*": 1.0, "scum": 3.0, "chón*": 1.5, "the": -0.5}, -1.0)
    texts = ["", "the the IDIOT!! idiots", "scum\nscum, (Scum)", "chónez CHÓNZ", "a b c", "__scum__ idio"]
    found = X.predict(model, pa.array(texts, pa.large_string()))
    for text, p in zip(texts, found):
        present = {f for w in text.lower().split() for f in X.features_of(X.cleaned(w))}
        assert abs(p - 1 / (1 + np.exp(1.0 - sum(model.weights.get(f, 0) for f in present)))) < 1e-12


def test_label_model_recovers_rates_and_sees_copies():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    on, off = [0.8, 0.7, 0.6, 0.5], [0.02, 0.05, 0.03, 0.04]
    votes = np.array([np.where(truth, rng.random(4000) < a, rng.random(4000) < b) for a, b in zip(on, off)] ).T.astype(float)
    votes = np.hstack([votes, votes[:, :1]])  # the last voter copies the first
    model = X.fit_label_model(votes)
    assert abs(model.prior - 0.3) < 0.05 and np.abs(model.rates[1][:4] - on).max() < 0.1
    assert model.weight[0] < 0.7 and model.weight[4] < 0.7 and model.weight[1] > 0.8
    assert ((X.posterior(model, votes) >= 0.5) == truth).mean() > 0.9


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = op9_toxicity(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").toPandas()
    toxic, other = rows[rows.toxic == 1], rows[rows.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.7 and (other.predicted == 0).mean() > 0.99
    assert rows.score.between(0, 1).all()


def test_edge_rows(spark, documents):
    docs = documents([(1, None), (2, ""), (None, "text"), (4, "long " * 100_000), (4, "text")])
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, toxic int")
    rows = X.score(docs, X.fit(docs, labels)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert X.score(documents([]), X.fit(documents([]), labels.where("false"))).count() == 0
