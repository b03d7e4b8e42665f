"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.session import written, written_and_measured

#: Links that one task contracts.
CHUNK_LINKS = 1_000_000


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links ``node, root`` of the components of a chunk of links: every node but the roots hangs on its smallest."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        for end in (x, y):  # hang the roots of both ends on the smaller one, then shorten all paths
            np.minimum.at(root, before[end], low)
            np.minimum.at(root, end, low)
        while (root != root[root]).any():
            root = root[root]
        if (root == before).all():
            moved = root != np.arange(len(names))
            return names[moved], names[root[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links = pa.Table.from_batches(batches, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    node, root = contracted(links.column("a").to_numpy(), links.column("b").to_numpy())
    yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(root, pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the undirected links ``(a, b)``: the smallest node that it reaches.

    Chunks of bounded size are contracted to stars in their own tasks. If there are several, two steps alternate until
    nothing changes: each node hangs its larger neighbours, then its smaller ones, on the smallest node that it
    knows. Rounds grow with the logarithm of the longest path between chunks; each is a written table, so a lost executor costs one
    round. Loops and repeated links do no harm.
    """
    edges, seen = written_and_measured(links.where("a <> b").select("a", "b"), "links", n=F.count("*"))
    chunks = -(-seen["n"] // CHUNK_LINKS)
    edges = edges.coalesce(max(chunks, 1)).mapInArrow(_contract, "a long, b long")
    edges = written(edges if chunks <= 1 else edges.distinct(), "links")
    before = None
    while chunks > 1:
        both = edges.union(edges.select("b", "a"))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        step = small.select("e.*").where("a <> b").distinct()
        edges, now = written_and_measured(step, "links", n=F.count("*"), h=F.expr("bit_xor(xxhash64(a, b))"))
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select("b", "b").distinct())
