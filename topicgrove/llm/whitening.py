"""Whitening of embeddings by shifted CholeskyQR over distributed Gram passes.

The different vectors, as integers, are the fit list. Each pass runs over it once: a task centres its rows exactly, undoes the
triangular factors found so far by triangular solves, and adds up the Gram matrix of what results; the sums meet in one small
matrix. Its Cholesky factor, shifted in the first pass so that it exists whatever the condition, is the next triangular factor. Once
the Gram matrix is the identity the factors are composed, and the singular values and right vectors of their product give the variances and the
components. The covariance itself is never formed to be decomposed, so small variances keep their digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicgrove.session import written

SCALE, OFFSET = 64, 1_000_000
#: Entries are integers of at most this size; larger ones make their row unusable, like infinite ones.
LARGEST = 1 << 40
#: Rows that are orthogonalised together.
BLOCK = 4096
MOST_PASSES = 8
EPS = np.finfo(np.float64).eps


class Whitening(NamedTuple):
    """``n`` fitted vectors with sums ``sums``; ``components`` are columns of length one, by falling ``variances``."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total_variance: float
    identity_error: float


def as_integers(vector: Column) -> Column:
    """``floor(64 c) + 1000000`` of every entry; null where the vector is null, empty, or holds a null, non-finite or too large entry."""
    entries = F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST / SCALE))
    return F.when(sound & (F.size(vector) > 0), F.transform(entries, lambda x: x.cast("long") + OFFSET))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def _exact(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - sums``: 64-bit integers where they fit, else Python's."""
    if n * max(LARGEST + OFFSET, 1) < 1 << 62 and max(map(abs, sums), default=0) < 1 << 62:
        return x * n - np.array(sums, np.int64)
    spread = x.astype(object) * n - np.array(sums, object)
    return spread.astype(np.int64) if max(map(abs, (spread.min(), spread.max()))) < 1 << 62 else spread


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _exact(x, n, sums).astype(np.float64) / n


def _solve(factors: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of each upper factor in turn, by forward substitution over columns."""
    for upper in factors:
        out = np.empty_like(rows)
        for j in range(upper.shape[0]):
            out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
        rows = out
    return rows


def _gram(fit: DataFrame, width: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of ``r r'`` and of ``r`` over the rows ``r`` that ``rows_of`` makes of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = 0.0, False
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            for low in range(0, len(x), BLOCK):
                r = rows_of(x[low : low + BLOCK])
                r = np.hstack([r, np.ones((len(r), 1))])
                total, some = total + r.T @ r, True
        if some:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])

    sums = fit.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = sums.toPandas()  # (width + 1) (width + 2) / 2 numbers
    size = int(found.j.max()) + 1
    full = np.zeros((size, size))
    full[found.i, found.j] = full[found.j, found.i] = found.v
    return full[:-1, :-1], full[:-1, -1]


def fit(vectors: DataFrame, column: str = "embedding", most: int = 16) -> Whitening | None:
    """Fit the first ``most`` components to the different integer vectors of ``column``; None where no row is usable.

    Rows of another length than the usual one (the most frequent, of equals the longest) are not fitted. Directions without
    variance have no component.
    """
    usable = vectors.select(as_integers(F.col(f"`{column}`")).alias("x")).where("x IS NOT NULL")
    width = usual_length(vectors, column)
    if not width:
        return None
    distinct = written(usable.where(F.size("x") == width).distinct(), "whitening_fit")
    entry = [F.sum(F.col("x")[k].cast("decimal(20,0)")).alias(f"s{k}") for k in range(width)]
    first = distinct.agg(F.count("*").alias("n"), *entry).first()
    n, sums = first["n"], [int(first[f"s{k}"]) for k in range(width)]

    factors: list[np.ndarray] = []
    error = np.inf
    for step in range(MOST_PASSES):
        gram, _ = _gram(distinct, width, lambda x: _solve(factors, _centred(x, n, sums)))
        if step == 0:
            spread = np.trace(gram)
            if spread <= 0:
                return Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0, 0.0)
        off = np.abs(gram - np.eye(width)).max()
        if step and (off <= 8 * width * EPS or off >= error / 2):
            break
        error = off if step else np.inf
        upper = _cholesky(gram, width, n, shifted=step == 0)
        factors.append(upper)
    product = np.eye(width)
    for upper in factors:
        product = upper @ product
    _, singular, right = np.linalg.svd(product)
    variances = singular**2 / n
    held = int(min(most, (singular > singular[0] * width * np.sqrt(EPS) * 1e-2).sum()))
    components, variances, total = right[:held].T, variances[:held], float((singular**2).sum() / n)

    scaled = components / np.sqrt(variances)
    _, drift = _gram(distinct, width, lambda x: _centred(x, n, sums) @ scaled)
    cov, _ = _gram(distinct, width, lambda x: _centred(x, n, sums) @ scaled - drift / n)
    return Whitening(n, sums, components, variances, total, float(np.abs(cov / n - np.eye(held)).max()))


def usual_length(vectors: DataFrame, column: str) -> int:
    """The most frequent length of usable vectors, of equals the longest; 0 where there is none."""
    sizes = vectors.select(F.size(as_integers(F.col(f"`{column}`"))).alias("width")).where("width > 0").groupBy("width").count()
    first = sizes.orderBy(F.desc("count"), F.desc("width")).first()
    return first.width if first else 0


def _cholesky(gram: np.ndarray, width: int, n: int, shifted: bool) -> np.ndarray:
    """The upper factor of a Gram matrix; shifted at first, or where rounding made it indefinite."""
    shift = 11 * (width * n + width * (width + 1)) * EPS * np.linalg.norm(gram, 2) if shifted else 0.0
    shift = min(shift, np.trace(gram) * 1e-3)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(width)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, width * EPS * np.trace(gram))


def whiten(vectors: DataFrame, model: Whitening | None, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per usable vector and component: ``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    Rows whose vector is null, empty, of another length than the fitted ones, or holds a null, non-finite or too large
    (2^34 and above) entry are left out. ``deviation`` is the exact sum of ``(n x - S)²``, null where it passes 64 bits.
    ``whitened`` is the centred vector along the component over the square root of its variance, ``explained`` the component's share of the
    variance, ``identity_error`` how far the fitted rows' whitened covariance is from the identity. Components without variance give no row;
    repeated rows and null ids are kept; other columns are not read.
    """
    kind = vectors.schema[id_column].dataType.simpleString()
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), as_integers(F.col(f"`{column}`")).alias("x"))
    width = len(model.sums) if model else -1
    usable = rows.where(F.col("x").isNotNull() & (F.size("x") == width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scaled = model.components / np.sqrt(model.variances)
        k = scaled.shape[1]
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                spread = _exact(_matrix(part.column("x"), width), model.n, model.sums)
                widest = max(abs(int(spread.min())), abs(int(spread.max())))
                if widest * widest * width >= 1 << 63:
                    spread = spread.astype(object)
                squares = (spread * spread).sum(axis=1).tolist()
                white = (spread.astype(np.float64) / model.n) @ scaled
                m = len(squares)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n)),
                        pc.take(pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()), pa.array(np.repeat(np.arange(m), k))),
                        pa.array(white.ravel()),
                        pa.array(np.tile(model.variances / model.total_variance, m)),
                        pa.array(np.full(m * k, model.identity_error)),
                    ],
                    names=["id", *(c.split()[0] for c in schema.split(", "))],
                )

    return usable.mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_column)
