"""Words, hashes, tables and Arrow batches that the operators of this part share."""

from __future__ import annotations

import contextlib
import sys
import types
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicgrove.session import written

#: Slices of the hashes of labelled ids whose sizes are counted.
SLICE_BITS = 14
#: ASCII white space: the separators of words.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; null gives an empty text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once per row however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo ``modulus``; null stays null."""
    return F.crc32(doc_id.cast("string")) % modulus


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a job are deleted when it ends and not when the driver happens to collect its garbage.

    For jobs whose result is a written table, which later jobs read instead.
    """
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def delete_written(table: DataFrame) -> None:
    """Delete the files of a table from ``written`` that no later job reads."""
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Inside, a setting of the session has this value; for jobs that end inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def once(key: tuple, make):
    """``make()``, once per Python process and key: what workers load from files is kept for the tasks that follow.

    The store is a module of its own, since the functions of this package travel by value and meet new globals in every task.
    """
    store = vars(sys.modules.setdefault("_topicgrove_kept", types.ModuleType("_topicgrove_kept")))
    if key not in store:
        store[key] = make()
    return store[key]


def slabs(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or of one row that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start, room = 0, limit
        for i, n in enumerate(size):
            if n > room and i > start:
                yield batch.slice(start, i - start)
                start, room = i, limit
            room -= n
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, text: str = "text") -> pa.Array:
    """The texts of a batch as strings with 64-bit offsets; empty ones for nulls.

    Slices are copied: pc.ascii_lower reads those of a larger array wrongly where there is no null.
    """
    column = batch.column(text)
    if column.offset:
        column = column.take(pa.array(np.arange(len(column))))
    return pc.fill_null(column.cast(pa.large_string()), "")


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in one array, and where each text's words start (one more entry than texts)."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not full.all():
        before = np.concatenate([[0], np.cumsum(full)])
        flat, starts = flat.filter(pa.array(full)), before[starts]
    return flat, starts


def sums_between(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of each slice ``values[starts[i]:starts[i + 1]]``; zero for empty ones."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def hash_strings(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string's bytes, the same in every process."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values.cast(pa.large_binary()).to_pylist()), np.uint64, len(values))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over all bits (a fixed bijection)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int, most_bytes: int) -> tuple[list[bytes], np.ndarray]:
    """At most ``per_class`` labelled texts of each class of at most ``most_bytes``, those whose ids have the smallest hashes.

    Longer texts and labels without a document are passed over before the draw, so a class fills its share where it can. An id with
    several texts gives the one with the smallest hash, an id with several labels the largest. Counts of hash slices tell which
    slices hold the draw, so that no class is sorted as a whole.
    """
    known = labels.where(usable & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    text = F.coalesce("text", F.lit(""))
    short = docs.where(F.octet_length(text) <= most_bytes).select("doc_id", F.xxhash64(text).alias("h"))
    drawable = written(short.join(known, "doc_id").groupBy("doc_id").agg(F.min("h").alias("h"), F.first("y").alias("y")).withColumn("at", F.xxhash64("doc_id")), "drawable")
    piece = F.shiftright("at", 64 - SLICE_BITS)
    sizes: dict[int, int] = {}
    last = {0: None, 1: None}
    for r in sorted(drawable.groupBy("y", piece.alias("piece")).count().collect()):  # at most 2^SLICE_BITS rows a class
        if sizes.get(r.y, 0) < per_class:
            sizes[r.y], last[r.y] = sizes.get(r.y, 0) + r["count"], r.piece
    order = ["at", "doc_id"]
    drawn = [drawable.where((F.col("y") == y) & (piece <= at)).orderBy(*order).limit(per_class) for y, at in last.items() if at is not None]
    if not drawn:
        return [], np.zeros(0, np.float32)
    rows = reduce(DataFrame.unionByName, drawn).select(F.col("doc_id").alias("drawn_id"), "h", "y")
    # at most twice ``per_class`` rows
    texts = docs.select("doc_id", text.alias("text")).join(F.broadcast(rows), (F.col("doc_id") == F.col("drawn_id")) & (F.xxhash64("text") == F.col("h")))
    found = sorted((r.doc_id, r.text.encode(), r.y) for r in texts.select("doc_id", "text", "y").dropDuplicates(["doc_id"]).collect())
    return [t for _, t, _ in found], np.array([y for *_, y in found], np.float32)
