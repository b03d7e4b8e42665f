import json

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from topicgrove.operators import classify, embedding
from topicgrove.operators.embedding import embedding_text, fit_encoder, embed
from topicgrove.operators.naming.base import name_clusters
from topicgrove.operators.naming.keyword import KEYWORD_NAMER
from topicgrove.operators.review import topic_tree
from topicgrove.sources.posts import read_post_stream, read_posts
from topicgrove.streaming.scoring import clean_stream, drop_republished, score_stream, write_stream

TOPICS = {1: "cats purr softly on warm mats", 2: "dogs bark loudly at red cars", 3: "rain falls slowly over green hills"}


@pytest.fixture(scope="module")
def posts(spark):
    rows = [
        (i, f"{TOPICS[c]} {i}", (TOPICS[c] + f" word{i} ") * 5, f"https://s.org/{i}", f"2022-01-{i % 28 + 1:02d}T00:00:00", c, 1 + c // 3)
        for i, c in enumerate([1, 2, 3] * 14)
    ]
    columns = "seq long, title string, text string, url string, date string, topic_level_2_cluster_id int, topic_level_1_cluster_id int"
    return spark.createDataFrame(rows, columns)


def test_split_is_stratified_and_repeatable(posts):
    split = classify.split_stratified(posts, "topic_level_2_cluster_id")
    sizes = split.groupBy("topic_level_2_cluster_id", "is_test").count().collect()
    assert sorted((r.is_test, r["count"]) for r in sizes) == [(False, 11)] * 3 + [(True, 3)] * 3
    again = classify.split_stratified(posts.repartition(5), "topic_level_2_cluster_id")
    assert {r.url for r in split.filter("is_test").collect()} == {r.url for r in again.filter("is_test").collect()}


def test_small_classes_are_refused(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "label int, url string")
    with pytest.raises(ValueError):
        classify.require_class_sizes(rows, "label")


@pytest.mark.parametrize("model", [lambda: None, lambda: RandomForestClassifier(numTrees=10, seed=1)])
def test_fit_score_predict(posts, model):
    embedded = embed(posts)
    fitted, accuracy = classify.classify(embedded, 2, model=model())
    assert accuracy == 1.0
    predicted = fitted.predict(embedded.withColumnRenamed("topic_level_2_cluster_id", "truth"))
    assert predicted.filter("truth != topic_level_2_cluster_id").count() == 0


def test_stream_equals_batch(spark, posts, tmp_path):
    tagged = name_clusters(posts, 2, KEYWORD_NAMER)
    tree = topic_tree(tagged, 2)
    encoder = fit_encoder(embedding_text(posts))
    model = classify.fit_model(embed(posts, encoder), "topic_level_2_cluster_id")
    landed = tmp_path / "in"
    landed.mkdir()
    rows = posts.collect()
    for part in range(3):
        page = [
            {"id": r.seq, "date": r.date, "link": r.url, "title": {"rendered": r.title}, "content": {"rendered": f"<p>{r.text}</p>"}}
            for r in rows[part::3]
        ]
        (landed / f"{part}.json").write_text(json.dumps(page))

    def scored(source):
        return score_stream(clean_stream(source), encoder, model, tree, 2).select("id", "topic_level_2_cluster_id", "topic_path")

    stream = scored(read_post_stream(spark, str(landed)))
    write_stream(stream, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    found = sorted(map(tuple, spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).collect()))
    assert found == sorted(map(tuple, scored(read_posts(spark, str(landed))).collect()))
    assert {r[1] for r in found} == {1, 2, 3} and len(found) == 42


def test_republished_urls_are_dropped(spark, tmp_path):
    landed = tmp_path / "in"
    landed.mkdir()
    page = [
        {"id": i, "date": f"2022-01-0{1 + i}T00:00:00", "link": f"https://s.org/{i % 2}", "title": {"rendered": "t"}, "content": {"rendered": "x"}}
        for i in range(4)
    ]
    (landed / "p.json").write_text(json.dumps(page))
    kept = drop_republished(read_post_stream(spark, str(landed))).select("url")
    write_stream(kept, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["https://s.org/0", "https://s.org/1"]


def test_bytes_of_an_encoder_batch(spark, posts):
    found = embed(posts, encoder=lambda texts: [[float(len(t))] for t in texts])
    assert found.select(F.size("text_embedding")).distinct().collect()[0][0] == 1


def test_a_fitted_encoder_and_its_vectors_from_one_cleaning(spark):
    posts = spark.createDataFrame([(i, f"title {i}", f"text {i % 3} of words") for i in range(9)], "seq long, title string, text string")
    cleaned = spark.sparkContext.accumulator(0)

    def clean(text):
        cleaned.add(1)
        return text

    encoder, embedded = embedding.fit_and_embed(posts, F.udf(clean, "string"))
    found = {r.seq: list(r.text_embedding) for r in embedded.collect()}
    assert cleaned.value == 9
    assert found == {r.seq: list(r.text_embedding) for r in embedding.embed(posts, encoder).collect()}
