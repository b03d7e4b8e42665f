from topicgrove.operators.naming import centrality
from topicgrove.operators.naming.centrality import centrality_namer, most_central_titles

ROWS = [
    (1, 0, "Red apple tart"),
    (1, 1, "red apple pie"),
    (1, 2, "green apple pie"),
    (1, 3, "apple_pie"),
    (1, 4, "Bicycle"),
    (1, 5, "apple_pie"),
    (2, 6, ""),
    (2, 7, None),
    (3, 8, "same same"),
    (None, 9, "nowhere"),
]


def _ranks(titles, rounds=10):
    words = [t.lower().replace("_", " ").split() for t in titles]
    weight = {}
    for ws in words:
        for a, b in zip(ws, ws[1:]):
            if a != b:
                weight[a, b] = weight.get((a, b), 0) + 1
                weight[b, a] = weight.get((b, a), 0) + 1
    ranks = {w: 1.0 for ws in words for w in ws}
    total = {w: sum(n for (a, _), n in weight.items() if a == w) for w in ranks}
    for _ in range(rounds):
        ranks = {w: 0.15 + 0.85 * sum(n / total[a] * ranks[a] for (a, b), n in weight.items() if b == w) for w in ranks}
    return {t: sum(ranks[w] for w in ws) / len(ws) for t, ws in zip(titles, words)}


def test_most_central_titles_equal_a_walk_by_hand(spark):
    titles = spark.createDataFrame(ROWS, "cluster_id int, seq long, title string")
    found = {r.cluster_id: r for r in most_central_titles(titles).collect()}
    scores = _ranks([t for c, _, t in ROWS if c == 1])
    assert set(found) == {1, 2, 3}
    assert found[1].title == max(scores, key=scores.get) and abs(found[1].score - max(scores.values())) < 1e-8
    assert found[2].title is None and found[2].score is None
    assert found[3].title == "same same" and abs(found[3].score - 0.15) < 1e-9


def test_parents_are_named_from_the_names_of_their_children(spark):
    namer = centrality_namer()
    titles = spark.createDataFrame(ROWS, "cluster_id int, seq long, title string")
    assert {r.cluster_id: r.tag for r in namer.leaf(titles).collect()} == {1: "apple_pie", 2: "unnamed", 3: "same_same"}
    children = spark.createDataFrame([(1, 0, "apple_pie"), (1, 3, "apple_tart"), (1, 5, "plum_pie"), (2, 1, "bread")], "cluster_id int, seq long, tag string")
    assert {r.cluster_id: r.tag for r in namer.parent(None, children, None).collect()} == {1: "apple_pie", 2: "bread"}
    assert namer.leaf(titles.limit(0)).count() == 0


def test_rounds_do_not_shuffle_the_edges_again(spark):
    shares = centrality._shares(
        spark.createDataFrame([(1, "a", "b", 2), (1, "b", "c", 1)], "cluster_id int, low string, high string, weight long"),
        spark.createDataFrame([(1, "a", 5), (1, "b", 6), (1, "c", 7)], "cluster_id int, word string, node long"),
    ).persist()
    ranks = spark.createDataFrame([(5, 1.0), (6, 1.0), (7, 1.0)], "node long, rank double")
    asked = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        once = centrality._passed_on(shares, ranks)
        plan = once._jdf.queryExecution().sparkPlan().toString(), once._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
        assert "InMemoryTableScan" in plan[0] and plan[1].count("Exchange hashpartitioning(") == 2  # the ranks, and what neighbours get
        assert {r.node: round(r.rank, 6) for r in once.collect()} == {5: 0.716667, 6: 1.85, 7: 0.433333}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", asked)
        shares.unpersist()
    worded = centrality._with_words(spark.createDataFrame(ROWS, "cluster_id int, seq long, title string"))
    assert {r["rank"] for r in centrality.word_ranks(worded, 0).collect()} == {1.0}
