"""Post sources: landed API pages, saved tables, and their union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicgrove.schema import POST_COLUMNS, RAW_POST
from topicgrove.session import written

SAVED_POST = T.StructType(
    [T.StructField(c, T.LongType() if c == "id" else T.StringType()) for c in POST_COLUMNS]
)


def normalise_posts(raw: DataFrame) -> DataFrame:
    """Unnest raw posts to ``text, title, url, date, id``; other columns are not read."""
    return raw.select(
        F.col("content.rendered").alias("text"),
        F.col("title.rendered").alias("title"),
        F.col("link").alias("url"),
        "date",
        "id",
    )


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows over all cores when they arrive in fewer input splits, as from one large file.

    Reading texts is much cheaper than cleaning them. A table with enough splits
    for all cores is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def read_posts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed JSON pages (one array of posts per file) as one table of posts.

    A file without posts adds no rows, so empty sites need no special case; a page that cannot be read ends the job. A
    page cannot be split and one task reads many small ones; land the result
    once with ``write_table`` and go on from there.
    """
    return spread(normalise_posts(spark.read.schema(RAW_POST).json(path, multiLine=True, mode="FAILFAST")), "url")


def read_post_stream(spark: SparkSession, path: str) -> DataFrame:
    """New JSON pages of a folder as a stream of posts."""
    return normalise_posts(spark.readStream.schema(RAW_POST).json(path, multiLine=True, mode="FAILFAST"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType = SAVED_POST) -> DataFrame:
    """A table saved as CSV with a header; quoted text may hold line breaks."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', mode="FAILFAST")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_seq(df: DataFrame, *order: str | Column) -> DataFrame:
    """Number the rows 0..n-1 in the given order as ``seq``.

    Rows are range-partitioned, sorted and written with their partition and
    place in it, and the partition sizes (one small row per partition) shift the
    places; full rows are shuffled once, and no task sees more than its own
    range. ``order`` must be unique for the numbering to be repeatable.
    """
    # the partition is in the upper bits of these numbers, the place in the lower 33
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = written(placed, "ranged").withColumn("_part", F.shiftright("_at", 33))
    sizes = ranged.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    place = F.col("_at").bitwiseAND((1 << 33) - 1)
    return ranged.join(starts, "_part").withColumn("seq", F.col("_start") + place).drop("_part", "_start", "_at")


def cap_per_site(posts: DataFrame, cap: int, site: str = "site") -> DataFrame:
    """The first ``cap`` posts of each site in ``seq`` order.

    Spark cuts every map task to ``cap`` rows per site before the shuffle, so a
    dominant site costs no more than a small one.
    """
    place = F.row_number().over(Window.partitionBy(site).orderBy("seq"))
    return posts.withColumn("_place", place).filter(F.col("_place") <= cap).drop("_place")


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """All rows of all sources; a column missing from one source is null there."""
    if not sources:
        raise ValueError("At least one source is needed.")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def first_rows(posts: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in ``seq`` order."""
    return posts.orderBy("seq").limit(n)
