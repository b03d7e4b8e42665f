from collections import defaultdict

from topicgrove.llm.mixing import inverse_demand, plan, targets, training_order
from pyspark.sql import functions as F


def test_inverse_demand_undoes_the_integral(spark):
    schedule = ((0.0, 0.5), (0.5, 0.5), (1.0, 1.5))
    shares = spark.createDataFrame([(x / 20,) for x in range(20)], "s double")

    def demand(t):
        return (0.5 * t if t <= 0.5 else 0.25 + 0.5 * (t - 0.5) + (t - 0.5) ** 2) / 0.75

    for r in shares.select("s", inverse_demand(F.col("s"), schedule).alias("t")).collect():
        assert abs(demand(r.t) - r.s) < 1e-9


def test_targets_fill_by_weight(spark):
    sizes = {"a": 100, "b": 10_000, "c": 5_000, "d": 1, "Z": 300, None: 50}
    found = {r.source: r.target for r in targets(spark.createDataFrame([(k, v, v) for k, v in sizes.items()], "source string, size long, words long")).collect()}
    order = sorted(k for k in sizes if k) + [None]
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
    left, capped = 1.5 * sum(sizes.values()), set()
    while True:  # share by weight, cap, share the rest again
        unit = (left - sum(2 * sizes[k] for k in capped)) / sum(weight[k] for k in order if k not in capped)
        over = {k for k in order if k not in capped and unit * weight[k] > 2 * sizes[k]}
        if not over:
            break
        capped |= over
    for k in order:
        assert abs(found[k] - (2 * sizes[k] if k in capped else unit * weight[k])) < 1e-6


def test_plan_comes_near_targets_and_order_rises(documents):
    rows = [(i, "w " * (i % 40), f"s{i % 4 if i % 3 else 0}") for i in range(1500)]
    rows += [(None, "w w", "s1"), (7, "w " * 7, "s3"), (7, "w " * 7, "s3"), (9000, None, "s2"), (9001, "", None), (9002, "w " * 5, None), (9003, "w " * 30000, "s0")]
    docs = documents([(i, t, s) for i, t, s in rows]).withColumn("source", F.col("source"))
    planned = plan(docs).collect()
    assert sum(r.n_rows for r in planned) == len(rows)
    taken, largest, target = defaultdict(int), defaultdict(int), {}
    for r in planned:
        assert r.taken in (0, r.size, 2 * r.size) and all(0 <= p < 1 for p in r.positions)
        taken[r.source] += r.taken * r.n_rows
        largest[r.source] = max(largest[r.source], r.size * r.n_rows)
        target[r.source] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= largest[s]
    ordered = training_order(docs).select("doc_id", "training_position").collect()
    at = [(r.training_position) for r in ordered]
    assert at == sorted(at) and len(at) == sum(len(r.positions) * r.n_rows for r in planned)
    assert plan(docs).exceptAll(plan(docs)).count() == 0


def test_no_rows(documents):
    assert plan(documents([])).count() == 0
    assert training_order(documents([])).count() == 0
