"""Single-linkage clusters: points connected by steps of at most a given distance.

One pass over all pairs serves every distance: a task that sees a block of points and a slice of all points joins what is near
enough, and names each of its points by the first one that it is connected with. These names are the links of a graph of
few edges, whose components are the clusters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.operators.tiles import (
    GRID_ROWS,
    TILE_QUERIES,
    TILE_ROWS,
    Estimates,
    against_all,
    exact_squares,
    grid,
    runs,
    squared_distances,
    vectors_of,
)
from topicgrove.schema import cluster_column, validate_distances
from topicgrove.session import written, written_and_measured
from topicgrove.sources.posts import with_seq

LINK = "level int, cluster long, other long"
NOISE = 1e-9
#: Pairs measured at a time.
MEASURED_PAIRS = 1 << 16


class Connected:
    """Points of a block and the rows that stream past, connected by steps of at most each distance (falling order)."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, distances: list[float]):
        self.ids, self.points, self.distances = [ids], points, distances
        self.n = len(ids)
        self.up = [np.arange(self.n) for _ in distances]  # the first point that each is connected with
        self.estimates = Estimates(points)

    def see(self, ids: np.ndarray, points: np.ndarray) -> None:
        base = len(self.up[0])
        self.ids.append(ids)
        self.up = [np.r_[up, np.arange(base, base + len(ids))] for up in self.up]
        others, norms = self.estimates.others(points)
        for low in range(0, len(ids), TILE_ROWS):
            part = slice(low, low + TILE_ROWS)
            for start in range(0, self.n, TILE_QUERIES):
                some = slice(start, min(start + TILE_QUERIES, self.n))
                open_ = [level for level, up in enumerate(self.up) if not self._one(up, some, base + low, base + low + len(points[part]))]
                if open_:
                    self._tile(some, base + low, points[part], others[part], norms[part], open_)

    @staticmethod
    def _one(up: np.ndarray, some: slice, low: int, high: int) -> bool:
        return bool((up[some] == up[low]).all() and (up[low:high] == up[low]).all())

    def _tile(self, some: slice, low: int, points: np.ndarray, others: np.ndarray, norms: np.ndarray, levels: list[int]) -> None:
        error = self.estimates.error(some, norms)
        if error is None:
            at = self.points[some]
            squares = squared_distances(at, points)
            error = NOISE * ((at**2).sum(axis=1) + (points**2).sum(axis=1).max())
        else:
            squares = self.estimates.squares(some, others)
        for level in reversed(levels):  # finer steps connect coarser levels as well
            most = self.distances[level] ** 2
            query, row = np.nonzero(squares <= (most * (1 + NOISE) + 2 * error).astype(squares.dtype)[:, None])
            a, b = query + some.start, row + low
            apart = self.up[level][a] != self.up[level][b]
            a, b = a[apart], b[apart]
            for first in range(0, len(a), MEASURED_PAIRS):
                x, y = a[first : first + MEASURED_PAIRS], b[first : first + MEASURED_PAIRS]
                near = np.sqrt(exact_squares(self.points[x], points[y - low])) <= self.distances[level]
                for coarser in range(level + 1):
                    self._join(coarser, x[near], y[near])

    def _join(self, level: int, a: np.ndarray, b: np.ndarray) -> None:
        up = self.up[level]
        while True:
            lo, hi = np.minimum(up[a], up[b]), np.maximum(up[a], up[b])
            apart = lo != hi
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(up, hi[apart], lo[apart])
            while True:
                further = up[up]
                if (further == up).all():
                    break
                up = further
            self.up[level] = up

    def links(self) -> pa.RecordBatch:
        ids = np.concatenate(self.ids)
        found = []
        for level, up in enumerate(self.up, 1):
            named = np.flatnonzero(ids != ids[up])
            found.append((np.full(len(named), level, np.int32), ids[named], ids[up[named]]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["level", "cluster", "other"])


def _connected(distances: list[float]):
    """The links of each block, for :func:`against_all`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[dict] = []
        state: Connected | None = None
        current = None
        for block, is_row, part in runs(batches):
            if block != current:
                if state is not None:
                    yield state.links()
                asked, state, current = [], None, block
            if not is_row:
                asked.append(part)
                continue
            if asked and state is None:
                ids, points = zip(*[(p["id"].to_numpy(), vectors_of(p["centroid"])) for p in asked])
                state = Connected(np.concatenate(ids), np.concatenate(points), distances)
            if state is not None:
                state.see(part["id"].to_numpy(), vectors_of(part["centroid"]))
        if state is not None:
            yield state.links()

    return run


def _roots(links: DataFrame) -> DataFrame:
    """``cluster, root``: follow links to their end; of two clusters that link to each other the smaller is one."""
    back = links.select(F.col("cluster").alias("other"), F.col("other").alias("back"))
    stop = (F.col("back") == F.col("cluster")) & (F.col("cluster") < F.col("other"))
    up = links.join(back, "other", "left").select("cluster", F.when(stop, F.col("cluster")).otherwise(F.col("other")).alias("root"))
    while True:
        hop = up.select(F.col("cluster").alias("root"), F.col("root").alias("next"))
        after = up.join(hop, "root", "left").select(
            "cluster", F.coalesce("next", "root").alias("to"), (F.coalesce("next", "root") != F.col("root")).alias("moved")
        )
        up, seen = written_and_measured(after.withColumnRenamed("to", "root"), "roots", moved=F.count_if("moved"))
        if not seen["moved"]:
            return up.select("cluster", "root")


def _components(links: DataFrame) -> DataFrame:
    """``cluster, root`` of every id in ``cluster, other``: ids that links connect have one root.

    Each round an id follows the link to its smallest neighbour; what is left are links between the roots.
    """
    names: DataFrame | None = None
    while True:
        both = links.unionByName(links.select(F.col("other").alias("cluster"), F.col("cluster").alias("other")))
        roots = _roots(written(both.groupBy("cluster").agg(F.min("other").alias("other")), "least"))
        if names is None:
            names = roots
        else:
            further = roots.select(F.col("cluster").alias("root"), F.col("root").alias("next"))
            names = written(names.join(further, "root", "left").select("cluster", F.coalesce("next", "root").alias("root")), "names")
        a = roots.select("cluster", F.col("root").alias("a"))
        b = roots.select(F.col("cluster").alias("other"), F.col("root").alias("b"))
        between = links.join(a, "cluster").join(b, "other").where("a <> b").select(F.col("a").alias("cluster"), F.col("b").alias("other")).distinct()
        links, seen = written_and_measured(between, "links", n=F.count(F.lit(1)))
        if not seen["n"]:
            return names


def single_linkage(
    points: DataFrame, distances: list[float], vector: str = "embedding", block_rows: int = GRID_ROWS
) -> DataFrame:
    """``id`` and one cluster id column per distance (falling order, level 1 first) of ``id, <vector>``.

    Two points share a cluster when steps of at most the distance connect them. Ids count
    from 1 in the order of the smallest point of each cluster.
    """
    distances = validate_distances(distances)
    value = F.col(vector).cast("array<double>").alias("centroid")
    state, seen = written_and_measured(points.select("id", value), "points", n=F.count(F.lit(1)))
    blocks, slices = grid(state, seen["n"], seen["n"], block_rows)
    links = written(against_all(state, state, blocks, [], _connected(distances), LINK, slices), "links")
    result = points.select("id")
    for level in range(len(distances), 0, -1):
        roots = _components(links.where(F.col("level") == level).select("cluster", "other").distinct())
        placed = state.select("id").join(roots, F.col("id") == F.col("cluster"), "left").select("id", F.coalesce("root", "id").alias("cluster"))
        placed = written(placed, "placed")
        names = with_seq(placed.groupBy("cluster").agg(F.min("id").alias("first")), "first")
        number = (F.col("seq") + 1).cast("int").alias(cluster_column(level))
        labels = written(placed.join(names.select("cluster", number), "cluster").drop("cluster"), "labels")
        result = result.join(labels, "id")
    return result.select("id", *[cluster_column(i) for i in range(1, len(distances) + 1)])
