"""Post tables derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicgrove.functions.text import word_runs
from topicgrove.sources.posts import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table of long texts, spread over all cores when its file has few splits."""
    return spread(table(spark, sf_dir, name), key)


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a post: its first line is the title, its source the site and leaf cluster."""
    number = F.regexp_extract("source", "[0-9]+", 0).try_cast("int")
    return texts(spark, sf_dir, "documents", "doc_id").select(
        F.col("doc_id").alias("seq"),
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        "text",
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.concat((F.lit(2017) + F.col("doc_id") % 8).cast("string"), F.lit("-06-01T08:00:00")).alias("date"),
        F.col("source").alias("site"),
        (F.floor(number / 5) + 1).cast("int").alias("topic_level_1_cluster_id"),
        (number + 1).cast("int").alias("topic_level_2_cluster_id"),
    )


def page_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every web page as a raw post."""
    return texts(spark, sf_dir, "pages", "page_id").select(
        F.col("page_id").alias("seq"),
        F.col("page_id").alias("id"),
        "url",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("text"),
        F.concat((F.lit(2017) + F.col("page_id") % 8).cast("string"), F.lit("-06-01T08:00:00")).alias("date"),
    )


def embedded_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, each with one of the vectors (by its number modulo theirs), clustered by the vector's label."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("text_embedding"), "label")
    of = F.pmod("seq", F.lit(max(vectors.count(), 1)))
    posts = document_posts(spark, sf_dir).drop("topic_level_1_cluster_id", "topic_level_2_cluster_id")
    return posts.join(vectors, of == F.col("vec_id")).select(
        *posts.columns,
        "text_embedding",
        (F.floor(F.col("label") / 4) + 1).cast("int").alias("topic_level_1_cluster_id"),
        (F.col("label") + 1).cast("int").alias("topic_level_2_cluster_id"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("text_embedding"), "label"
    )


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A knowledge table: every line of every benchmark item is a concept title."""
    return table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", "\n")).alias("title"))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word table: in each benchmark item that holds a word, the item's first word is the broader term."""
    items = table(spark, sf_dir, "benchmark").select("item_id", word_runs(F.lower("text")).alias("words"))
    each = items.select("item_id", F.explode(F.array_distinct("words")).alias("word"), F.get("words", F.lit(0)).alias("lemma"))
    rank = F.dense_rank().over(Window.partitionBy("word").orderBy("item_id"))
    return each.select("word", rank.alias("sense_rank"), "lemma")
