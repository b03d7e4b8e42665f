"""Quality classifier: a convolutional network over bytes, in numpy.

Bytes are embedded and read by filters eight bytes wide at every fourth byte. Responses are max-pooled over overlapping chunks of 256
bytes, half a chunk apart, which cover the whole document. The mean and the maximum of the pooled chunks are combined
into one probability. Chunks are computed in runs of fixed size, so a document of any length takes bounded memory.

The network is trained on a bounded sample of labelled documents; scoring runs where the documents are, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.llm.common import bucket_of, labelled_sample, slabs, texts_of

STEP, WIDTH, DIMENSIONS, FILTERS = 4, 8, 8, 32
BLOCK = 32  # steps: half a chunk
RUN_BLOCKS = 2048
#: The training sample: documents of each class at most, the longest text taken, passes over it.
SAMPLE_PER_CLASS, SAMPLE_BYTES, EPOCHS, BATCH = 600, 64 << 10, 10, 24
PAD = 256


class Net(NamedTuple):
    embedding: np.ndarray  # 257 x DIMENSIONS; the last row, zero, fills up blocks
    filters: np.ndarray  # (WIDTH * DIMENSIONS) x FILTERS
    bias: np.ndarray
    output: np.ndarray  # 2 * FILTERS
    offset: np.ndarray  # one number


def fresh(seed: int = 7) -> Net:
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.5, (257, DIMENSIONS))
    embedding[PAD] = 0
    filters = rng.normal(0, (WIDTH * DIMENSIONS) ** -0.5, (WIDTH * DIMENSIONS, FILTERS))
    return Net(*[x.astype(np.float32) for x in (embedding, filters, np.zeros(FILTERS), rng.normal(0, 0.1, 2 * FILTERS), np.zeros(1))])


def to_blocks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text filled up to whole blocks (one at least), and the first block of each text."""
    size = BLOCK * STEP
    counts = np.array([max(1, -(-len(t) // size)) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(counts)])
    data = np.full(int(starts[-1]) * size, PAD, np.uint16)
    for text, at in zip(texts, starts):
        data[at * size : at * size + len(text)] = np.frombuffer(text, np.uint8)
    return data, starts


def _steps(net: Net, data: np.ndarray) -> np.ndarray:
    """Embedded bytes, one row per step of STEP bytes."""
    return net.embedding[data].reshape(-1, STEP * DIMENSIONS)


def responses(net: Net, data: np.ndarray, after: np.ndarray, last_block: np.ndarray) -> np.ndarray:
    """Filter responses ``blocks x BLOCK x FILTERS``; ``after`` is the step that follows, ``last_block`` marks ends of texts."""
    half = STEP * DIMENSIONS
    steps = np.concatenate([_steps(net, data), _steps(net, after)])
    late = (steps @ net.filters[half:])[1:]
    late[(np.flatnonzero(last_block) + 1) * BLOCK - 1] = 0  # a filter does not read into the next text
    return (steps[:-1] @ net.filters[:half] + late + net.bias).reshape(-1, BLOCK, FILTERS)


def block_peaks(net: Net, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The maximum of each filter in each block, computed in runs of ``RUN_BLOCKS``."""
    size, n = BLOCK * STEP, int(starts[-1])
    last = np.zeros(n, bool)
    last[starts[1:] - 1] = True
    peaks = np.empty((n, FILTERS), np.float32)
    for a in range(0, n, RUN_BLOCKS):
        b = min(a + RUN_BLOCKS, n)
        after = data[b * size : b * size + STEP] if b < n else np.full(STEP, PAD, np.uint16)
        peaks[a:b] = responses(net, data[a * size : b * size], after, last[a:b]).max(axis=1)
    return peaks


def _chunks(peaks: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled chunks, two neighbouring blocks of one text each, and whether the second block holds the maximum."""
    following = np.concatenate([peaks[1:], peaks[-1:]])
    following[starts[1:] - 1] = -np.inf
    second = following > peaks
    return np.maximum(np.where(second, following, peaks), 0), second


def _probability(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def combine(net: Net, peaks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    chunks, _ = _chunks(peaks, starts)
    mean = np.add.reduceat(chunks, starts[:-1]) / np.diff(starts)[:, None]
    most = np.maximum.reduceat(chunks, starts[:-1])
    return _probability(np.hstack([mean, most]).astype(np.float64) @ net.output + net.offset[0])


def predict(net: Net, texts: list[bytes]) -> np.ndarray:
    """The probability of label 1 of each text."""
    data, starts = to_blocks(texts)
    return combine(net, block_peaks(net, data, starts), starts)


def _gradients(net: Net, texts: list[bytes], labels: np.ndarray) -> Net:
    data, starts = to_blocks(texts)
    last = np.zeros(int(starts[-1]), bool)
    last[starts[1:] - 1] = True
    every = responses(net, data, np.full(STEP, PAD, np.uint16), last)
    where = every.argmax(axis=1)
    peaks = np.take_along_axis(every, where[:, None], axis=1)[:, 0]
    chunks, second = _chunks(peaks, starts)
    counts = np.diff(starts)
    mean = np.add.reduceat(chunks, starts[:-1]) / counts[:, None]
    most = np.maximum.reduceat(chunks, starts[:-1])
    features = np.hstack([mean, most])
    error = ((_probability(features @ net.output + net.offset[0]) - labels) / len(labels)).astype(np.float32)
    d_features = error[:, None] * net.output
    owner = np.repeat(np.arange(len(texts)), counts)
    d_chunks = d_features[owner, :FILTERS] / counts[owner, None]
    at_most = chunks == most[owner]
    share = np.add.reduceat(at_most.astype(np.float32), starts[:-1])
    d_chunks += at_most * d_features[owner, FILTERS:] / share[owner]
    d_chunks *= chunks > 0
    d_peaks = np.where(second, 0, d_chunks)
    d_peaks[1:] += np.where(second, d_chunks, 0)[:-1]
    # each peak passes its gradient to the two steps that its filter read
    step = (np.arange(len(where)) * BLOCK)[:, None] + where
    half, steps = STEP * DIMENSIONS, np.concatenate([_steps(net, data), np.zeros((1, STEP * DIMENSIONS), np.float32)])
    follows = ~(last[:, None] & (where == BLOCK - 1))
    d_filters = np.empty_like(net.filters)
    d_steps = np.zeros_like(steps)
    for f in range(FILTERS):
        g = d_peaks[:, f]
        d_filters[:half, f] = g @ steps[step[:, f]]
        d_filters[half:, f] = (g * follows[:, f]) @ steps[step[:, f] + 1]
        d_steps[step[:, f]] += g[:, None] * net.filters[:half, f]
        d_steps[step[:, f] + 1] += (g * follows[:, f])[:, None] * net.filters[half:, f]
    touched = np.flatnonzero(d_steps[:-1].any(axis=1))
    spread = d_steps[touched].reshape(-1, DIMENSIONS)
    read = data.reshape(-1, STEP)[touched].ravel()
    d_embedding = np.stack([np.bincount(read, spread[:, k], minlength=257) for k in range(DIMENSIONS)], axis=1).astype(np.float32)
    d_embedding[PAD] = 0
    return Net(d_embedding, d_filters, d_peaks.sum(axis=0), error @ features, np.array([error.sum()], np.float32))


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Net:
    """Fit by Adam on the log loss. The same rows in the same order give the same network."""
    net, rng = fresh(seed), np.random.default_rng(seed)
    first, second = [np.zeros_like(x) for x in net], [np.zeros_like(x) for x in net]
    tick, total = 0, epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            pick = order[a : a + BATCH]
            rate = 0.01 * (1 - tick / total) + 0.0005
            tick += 1
            new = []
            for x, g, m, v in zip(net, _gradients(net, [texts[i] for i in pick], labels[pick]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                new.append((x - rate * (m / (1 - 0.9**tick)) / (np.sqrt(v / (1 - 0.999**tick)) + 1e-8)).astype(np.float32))
            net = Net(*new)
    return net


def fit(docs: DataFrame, labels: DataFrame) -> Net:
    """Learn ``labels.quality`` from rows whose crc32(id) mod 3 is not 1; the classes weigh as often as they are labelled."""
    usable = bucket_of(F.col("doc_id"), 3) != 1
    texts, truth = labelled_sample(docs, labels, "quality", usable, SAMPLE_PER_CLASS, SAMPLE_BYTES)
    if len(set(truth.tolist())) < 2:  # nothing tells the classes apart: every text scores 0.5
        return Net(*map(np.zeros_like, fresh()))
    net = train(texts, truth)
    good, bad = labels.where(usable).agg(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)).first()
    drawn = truth.sum()
    return net._replace(offset=net.offset + np.float32(np.log((good + 1) / (bad + 1)) - np.log((drawn + 1) / (len(truth) - drawn + 1))))


def score(docs: DataFrame, net: Net, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (its id unless given) with ``score`` and ``predicted``, one row per row.

    Only the text decides. Null and empty texts score as a document of no bytes; null ids and repeated rows are kept as they are.
    No rows give no rows. Where a class has no training row, every text scores 0.5 and is predicted 1.
    """
    columns = columns or ["doc_id"]
    scored = _scored(docs, net, columns)
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], "score", "predicted")


def accepted(docs: DataFrame, net: Net) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with its columns, whatever their names."""
    return _scored(docs, net, docs.columns).where("predicted = 1").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def _scored(docs: DataFrame, net: Net, columns: list[str]) -> DataFrame:
    """``columns`` as ``c0, c1, ...`` with ``score`` and ``predicted``."""
    held = [f"c{i}" for i in range(len(columns))]
    fields = "".join(f"{c} {docs.schema[name].dataType.simpleString()}, " for c, name in zip(held, columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, limit=1 << 20):
            texts = texts_of(batch).cast(pa.large_binary()).to_pylist()
            scores = predict(net, texts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in held], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], [*held, "score", "predicted"]
            )

    return docs.select(*[docs[f"`{name}`"].alias(c) for c, name in zip(held, columns)], "text").mapInArrow(run, f"{fields}score double, predicted int")
