import math

import numpy as np
import pytest

from topicgrove.llm.registry import QUERIES
from topicgrove.llm.whitening import fit, whiten

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def usable(v):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)


def check(rows, found, most=16):
    """``found`` against a dense eigendecomposition of the covariance over the different integer vectors."""
    ints = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in v)) for i, v in rows if usable(v)]
    distinct = sorted({x for _, x in ints})
    n, width = len(distinct), len(distinct[0])
    sums = [sum(x[k] for x in distinct) for k in range(width)]
    centred = np.array([[float(n * x[k] - sums[k]) / n for k in range(width)] for x in distinct])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    held = min(most, int((e > e[0] * 1e-12).sum()))
    assert len(found) == len(ints) * held and all(r.n == n for r in found)
    by = {(r.vec_id, r.component): r for r in found}
    signs = {}
    for i, x in ints:
        assert by[i, 1].deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        row = np.array([float(n * a - s) / n for a, s in zip(x, sums)])
        for k in range(held):
            r = by[i, k + 1]
            expected = row @ v[:, k] / np.sqrt(e[k])
            if abs(expected) > 1e-3:
                signs.setdefault(k, np.sign(expected * r.whitened))
            assert abs(signs.get(k, 1) * r.whitened - expected) < 1e-6
            assert abs(r.explained / (e[k] / e.sum()) - 1) < 1e-9 and r.identity_error < 1e-10


def table(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, n long, x string, component int")


def run(spark, rows, **options):
    vectors = table(spark, rows).repartition(3)
    out = whiten(vectors, fit(vectors, **options))
    assert out.columns == COLUMNS
    return out.collect()


def test_equals_an_eigendecomposition(spark):
    rng = np.random.default_rng(3)
    mixed = rng.normal(size=(150, 8)) @ np.diag([3, 2, 1.5, 1, 0.7, 0.5, 0.3, 0.1])
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)] + [(900 + i, mixed[0].tolist()) for i in range(30)]
    rows += [(1000, None), (1001, []), (1002, [None] + [0.0] * 7), (1003, [float("nan")] * 8), (1004, [float("inf")] + [0.0] * 7), (1005, [1e30] + [0.0] * 7), (1006, [1.0, 2.0])]
    known = [(i, v) for i, v in rows if i < 1000]
    found = run(spark, rows)
    check(known, found)
    check(known, run(spark, rows, most=3), most=3)


def test_narrow_directions_and_offsets(spark):
    rng = np.random.default_rng(4)
    mixed = rng.normal(size=(400, 5)) * [1000, 100, 10, 1, 0.1] + [1e4, -2e4, 0, 5, 1]
    check([(i, v.tolist()) for i, v in enumerate(mixed)], run(spark, [(i, v.tolist()) for i, v in enumerate(mixed)]))


def test_dependent_directions_have_no_component(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i, (a, b) in enumerate(rng.integers(-200, 200, (60, 2)).tolist()):
        rows.append((i, [a / 64, b / 64, (a + b) / 64, 3.0]))
    check(rows, run(spark, rows))


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [float("nan")])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    assert run(spark, rows) == []


def test_ties_and_null_ids(spark):
    rows = [(None, [1.0, 0.0]), (None, [-1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, -1.0])]
    found = run(spark, rows)
    assert len(found) == 8 and all(abs(r.explained - 0.5) < 1e-12 and r.identity_error < 1e-12 for r in found)


def test_query_over_the_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(rows, QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001").collect())
