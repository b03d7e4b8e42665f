"""Assigning rows to their nearest centroid.

Rows are dealt evenly into slices of bounded size. The task of a slice holds its rows while all centroids stream past in label
order, so any number of centroids meets any number of rows, nothing passes through the driver, and no pair becomes a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicgrove.operators.tiles import exact_squares, squared_distances, vectors_of

#: Rows of a slice, and at least so many where there are cores for more slices.
SLICE_ROWS, SMALL_SLICE_ROWS = 8192, 128
#: Rows that meet a batch of centroids together.
POINTS = 256
NOISE = 1e-9


def nearest_of(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position and distance of the nearest centroid of each point, ties by position."""
    rough = squared_distances(points, centroids)
    scale = (points**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1)[None, :]
    bound = (rough + NOISE * scale).min(axis=1)
    point, centroid = np.nonzero(rough - NOISE * scale <= bound[:, None])
    exact = exact_squares(points[point], centroids[centroid])
    order = np.lexsort((centroid, exact, point))
    point, centroid, exact = point[order], centroid[order], exact[order]
    first = np.flatnonzero(np.r_[True, np.diff(point) != 0])
    return centroid[first], np.sqrt(exact[first])


class Slice:
    """The rows of a slice with their nearest centroid so far."""

    def __init__(self):
        self.rows: list[pa.Array] = []
        self.vectors: list[np.ndarray] = []
        self.points: np.ndarray | None = None

    def hold(self, rows: pa.Array, vectors: np.ndarray) -> None:
        self.rows.append(rows)
        self.vectors.append(vectors)

    def _ready(self) -> None:
        if self.points is None:
            self.points = np.concatenate(self.vectors)
            self.nearest, self.distance = np.zeros(len(self.points), np.int64), np.full(len(self.points), np.inf)

    def see(self, labels: np.ndarray, centroids: np.ndarray) -> None:
        """Improve on the centroids before, whose labels are not larger."""
        self._ready()
        for low in range(0, len(self.points), POINTS):
            part = slice(low, low + POINTS)
            position, found = nearest_of(self.points[part], centroids)
            better = found < self.distance[part]
            self.nearest[part][better], self.distance[part][better] = labels[position[better]], found[better]

    def results(self) -> Iterator[pa.RecordBatch]:
        self._ready()
        low, found = 0, np.isfinite(self.distance)
        for rows in self.rows:
            part = slice(low, low + len(rows))
            nearest, distance = pa.array(self.nearest[part], mask=~found[part]), pa.array(self.distance[part], mask=~found[part])
            yield pa.RecordBatch.from_arrays([rows, nearest, distance], ["row", "nearest", "distance"])
            low += len(rows)


def nearest_centroid(rows: DataFrame, centroids: DataFrame, vector: str = "text_embedding", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Rows with ``nearest`` (a label) and ``distance``; ``centroids`` has ``label, centroid``.

    Ties go to the smaller label. A row without a vector, and every row where there is no centroid, gets nulls.
    """
    value = F.col(vector).cast("array<double>")
    asking = rows.where(F.col(vector).isNotNull())
    n = asking.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    slices = max(1, math.ceil(n / slice_rows), min(cores, math.ceil(n / SMALL_SLICE_ROWS)))
    asked = asking.select(
        F.pmod(F.monotonically_increasing_id(), F.lit(slices)).cast("int").alias("slice"), F.struct("*").alias("row"),
        F.lit(None).cast("long").alias("label"), value.alias("vector"),
    )
    kind = asked.schema["row"].dataType
    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    passing = centroids.select(every, F.lit(None).cast(kind).alias("row"), F.col("label").cast("long"), F.col("centroid").cast("array<double>").alias("vector"))
    streams = asked.unionByName(passing.where("label IS NOT NULL")).repartitionById(slices, "slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, Slice()
        for batch in batches:
            at, passes = batch.column("slice").to_numpy(), batch.column("label").is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(at) != 0) | (np.diff(passes.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(at)]):
                if b <= a:
                    continue
                part = batch.slice(a, b - a)
                if at[a] != current:
                    if held.rows:
                        yield from held.results()
                    current, held = at[a], Slice()
                if not passes[a]:
                    held.hold(part.column("row"), vectors_of(part.column("vector")))
                elif held.rows:
                    held.see(part.column("label").to_numpy(), vectors_of(part.column("vector")))
        if held.rows:
            yield from held.results()

    schema = T.StructType([T.StructField("row", kind), T.StructField("nearest", T.LongType()), T.StructField("distance", T.DoubleType())])
    found = streams.sortWithinPartitions("slice", F.asc_nulls_first("label")).mapInArrow(run, schema)
    none = rows.where(F.col(vector).isNull()).select("*", F.lit(None).cast("long").alias("nearest"), F.lit(None).cast("double").alias("distance"))
    return found.select("row.*", "nearest", "distance").unionByName(none)
