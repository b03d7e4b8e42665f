import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topicgrove.operators import quality, review
from topicgrove.operators.naming import base
from topicgrove.operators.naming.extractive import extractive_namer
from topicgrove.operators.naming.gazetteer import gazetteer_namer
from topicgrove.operators.naming.generative import generate_tags, generative_namer
from topicgrove.operators.naming.hypernym import hypernym_namer
from topicgrove.operators.naming.keyword import KEYWORD_NAMER
from topicgrove.operators.naming.tfidf import seed_words, tfidf_namer
from topicgrove.operators.naming.unique import unique_tags

TITLES = [
    ("Easy Vegan Chili", 1, 1),
    ("Best Vegan Chili Recipe", 1, 1),
    ("Vegan Soup", 1, 1),
    ("Vegan Chili", 2, 1),
    ("Chili Vegan Bowl", 2, 1),
    ("Vegan Chili", 3, 2),
    ("12 to 5", 4, 2),
]
COLUMNS = "seq long, title string, text string, url string, topic_level_2_cluster_id int, topic_level_1_cluster_id int"


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(i, t, "x", f"u{i}", leaf, top) for i, (t, leaf, top) in enumerate(TITLES)]
    return spark.createDataFrame(rows, COLUMNS)


def _tags(named, level):
    return {r[0]: r[1] for r in named.select(f"topic_level_{level}_cluster_id", f"topic_level_{level}").distinct().collect()}


def test_keyword_tags_golden(posts):
    named = base.name_clusters(posts, 2, KEYWORD_NAMER)
    assert _tags(named, 2) == {1: "vegan_chili", 2: "vegan_chili_bowl", 3: "vegan_chili_7", 4: "unknown_topic"}
    assert _tags(named, 1) == {1: "vegan", 2: "vegan_chili_unknown"}
    again = base.name_clusters(named, 2, KEYWORD_NAMER)
    assert sorted(again.columns) == sorted(named.columns)
    assert sorted(again.select(named.columns).collect()) == sorted(named.collect())


def test_posts_without_a_cluster_keep_null_tags(spark, posts):
    extra = spark.createDataFrame([(99, "Lost", "x", "u99", None, None)], COLUMNS)
    named = base.name_clusters(posts.union(extra), 2, KEYWORD_NAMER)
    assert named.count() == 8 and named.filter("seq = 99 AND topic_level_2 IS NULL").count() == 1
    assert review.review(named, 2).agg(F.sum("url_count")).first()[0] == 7


def _greedy(candidates, taken):
    used, tags = set(taken), {}
    for cluster in sorted(candidates):
        *contested, last = candidates[cluster]
        tags[cluster] = next((c for c in contested if c not in used), last)
        used.add(tags[cluster])
    return tags


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_unique_tags_equal_the_greedy_result(spark, seed):
    chance = random.Random(seed)
    words = [f"t{i}" for i in range(chance.randint(2, 12))]
    candidates = {c: [chance.choice(words) for _ in range(5)] + [f"last{c}"] for c in range(chance.randint(1, 15))}
    taken = chance.sample(words, chance.randint(0, 2))
    rows = spark.createDataFrame(list(candidates.items()), "cluster_id int, candidates array<string>")
    reserved = spark.createDataFrame([(t,) for t in taken], "tag string") if taken else None
    found = {r.cluster_id: r.tag for r in unique_tags(rows, reserved).collect()}
    assert found == _greedy(candidates, taken)


def test_tfidf_golden(spark):
    rows = spark.createDataFrame(
        [(1, "apple pie"), (1, "apple tart"), (2, "banana bread"), (2, "banana pie"), (3, "the"), (4, " ")],
        "cluster_id int, title string",
    )
    two = rows.filter("cluster_id < 3")
    found = {r.cluster_id: r.seeds for r in seed_words(two, "title", 5).collect()}
    assert found == {1: ["apple", "tart", "pie"], 2: ["banana", "bread", "pie"]}
    tags = {r.cluster_id: r.tag for r in tfidf_namer().leaf(rows).collect()}
    assert tags == {1: "apple_tart_pie", 2: "banana_bread_pie", 3: "unnamed", 4: "unnamed"}


def test_tfidf_levels(posts):
    named = base.name_clusters(posts, 2, tfidf_namer())
    assert None not in _tags(named, 1).values() and len(_tags(named, 2)) == 4


def test_gazetteer(spark, posts):
    concepts = spark.createDataFrame([("Chili con carne",), ("Chili (disambiguation)",), ("A Vegan diet book",)], "title string")
    named = base.name_clusters(posts, 2, gazetteer_namer(concepts))
    assert _tags(named, 2)[3] == "a_vegan_diet_book_chili_()"
    assert _tags(named, 2)[4] == "unnamed"
    assert _tags(named, 1)[2] == "a_vegan_diet_book_chili_()"


def test_hypernyms(spark, posts):
    lexicon = spark.createDataFrame(
        [("chili", 1, "stew"), ("chili", 1, "chile_dish"), ("chili", 2, "chill"), ("soup", 1, "dish")],
        "word string, sense_rank int, lemma string",
    )
    named = base.name_clusters(posts, 2, hypernym_namer(lexicon))
    assert _tags(named, 2)[2] == "chile_dish" and _tags(named, 2)[4] == "unnamed"
    vectors = spark.createDataFrame([("chili", [1.0, 0.0]), ("stew", [1.0, 0.1]), ("vegan", [1.0, 0.0])], "word string, vector array<double>")
    assert _tags(base.name_clusters(posts, 2, hypernym_namer(lexicon, vectors=vectors)), 2)[2] == "stew"


def test_extractive(posts):
    placed = posts.withColumn("text_embedding", F.array(F.col("seq").cast("float"), F.lit(1.0).cast("float")))
    named = base.name_clusters(placed, 2, extractive_namer())
    assert _tags(named, 2) == {1: "best_vegan_chili_recipe", 2: "vegan_chili", 3: "vegan_chili", 4: "12_to_5"}
    assert _tags(named, 1)[1] == "vegan_soup"


def test_generated_tags_ask_again_on_a_collision(posts):
    def answer(prompts: pd.Series, temperatures: pd.Series) -> pd.Series:
        return pd.Series([f"Heat {round(10 * t)}. ignored" for t in temperatures])

    named = base.name_clusters(posts, 2, generative_namer(answer))
    assert _tags(named, 2) == {1: "heat_2", 2: "heat_3", 3: "heat_4", 4: "heat_5"}
    assert _tags(named, 1) == {1: "heat_6", 2: "heat_7"}


def test_generator_that_never_varies_ends(spark):
    items = spark.createDataFrame([(1, ["a"]), (2, ["b"]), (3, ["c"])], "cluster_id int, items array<string>")
    from topicgrove.functions.tags import leaf_prompt

    tags = generate_tags(items, leaf_prompt, lambda p, t: pd.Series([None] * len(p), dtype=object), max_rounds=2)
    assert {r.cluster_id: r.tag for r in tags.collect()} == {1: "error_tag", 2: "error_tag_2", 3: "error_tag_3"}
    assert generative_namer(None) is KEYWORD_NAMER


def test_review_and_lookups(spark, posts):
    named = base.name_clusters(posts, 2, KEYWORD_NAMER)
    assert [tuple(r) for r in review.review(named, 2).collect()][0] == (1, 1, "vegan", "vegan_chili", 3)
    assert review.review_subset(named, 2, 1, [2]).count() == 2
    assert review.review_subset(named, 2, 1, [9]).count() == 0
    assert review.titles_in_cluster(named, 2, 2).count() == 2
    assert review.titles_in_cluster(named, 2, 77).count() == 0
    totals = review.review(named, 2, rollup=True).filter("topic_level_2 IS NULL").collect()
    assert [r.url_count for r in totals] == [5, 2]
    renamed = base.rename_cluster(named, 2, 4, "numbers")
    assert _tags(renamed, 2)[4] == "numbers" and _tags(renamed, 2)[1] == "vegan_chili"
    names = spark.createDataFrame([(1, "a"), (2, "b")], "cluster_id int, tag string")
    assert _tags(base.rename_clusters(named, 2, names), 2) == {1: "a", 2: "b", 3: "vegan_chili_7", 4: "unknown_topic"}
    tree = review.topic_tree(named, 2)
    asked = spark.createDataFrame([(3,), (8,)], "topic_level_2_cluster_id int")
    paths = {r.topic_level_2_cluster_id: r.topic_path for r in review.topic_paths(asked, tree, 2).collect()}
    assert paths == {3: "vegan_chili_unknown > vegan_chili_7", 8: None}
    parents = {r[0]: r.parents for r in review.parents_of(named, asked, 2).collect()}
    assert parents == {3: [2], 8: None}
    top = spark.createDataFrame([(1,)], "topic_level_1_cluster_id int")
    assert review.parents_of(named, top, 1).first().parents == []


def test_quality(posts):
    named = base.name_clusters(posts.withColumn("site", F.when(F.col("seq") < 2, "a").otherwise("b")), 2, KEYWORD_NAMER)
    overlap = {r.level: r for r in quality.tag_overlap(named, 2).collect()}
    assert (overlap[2].tags, overlap[2].overlapping_tags, overlap[2].shared_words, overlap[2].most_shared) == (4, 3, 2, 3)
    coverage = {r.level: r for r in quality.site_coverage(named, 2).collect()}
    assert coverage[2].shared_clusters == 1 and coverage[1].clusters == 2
    assert {r.level: r.mean_urls for r in quality.size_distribution(named, 2).collect()} == {1: 3.5, 2: 1.75}
