"""Quality measures of a topic tree, one row per level each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.functions.tags import tag_words
from topicgrove.schema import cluster_column, tag_column


def level_nodes(posts: DataFrame, num_levels: int, *columns: str) -> DataFrame:
    """``level, cluster_id, tag`` and further columns of all posts, one row per post and level."""
    nodes = F.array(
        *[
            F.struct(
                F.lit(i).alias("level"),
                F.col(cluster_column(i)).cast("int").alias("cluster_id"),
                F.col(tag_column(i)).alias("tag"),
            )
            for i in range(1, num_levels + 1)
        ]
    )
    return posts.select(F.inline(nodes).alias("level", "cluster_id", "tag"), *columns).filter("cluster_id IS NOT NULL")


def tag_overlap(posts: DataFrame, num_levels: int) -> DataFrame:
    """How much the tags of a level share words: none is best.

    ``tags`` counts the clusters, ``shared_words`` the words found in several of
    them, ``most_shared`` the clusters of the commonest word and
    ``overlapping_tags`` the clusters that hold a shared word. Counting words
    needs no pairs of tags, so a word that many tags share costs nothing extra.
    """
    nodes = level_nodes(posts, num_levels).distinct()
    words = nodes.select("level", "cluster_id", F.explode_outer(F.array_distinct(tag_words(F.col("tag")))).alias("word"))
    users = words.filter("word IS NOT NULL").groupBy("level", "word").agg(F.count("*").alias("users"))
    each = words.join(users, ["level", "word"], "left").groupBy("level", "cluster_id").agg(F.max("users").alias("users"))
    clusters = each.groupBy("level").agg(
        F.count("*").alias("tags"), F.count_if(F.col("users") > 1).alias("overlapping_tags")
    )
    shared = users.groupBy("level").agg(
        F.count_if(F.col("users") > 1).alias("shared_words"), F.max("users").alias("most_shared")
    )
    return clusters.join(shared, "level", "left").select(
        "level",
        "tags",
        "overlapping_tags",
        F.coalesce("shared_words", F.lit(0)).alias("shared_words"),
        F.coalesce("most_shared", F.lit(0)).alias("most_shared"),
    )


def _urls_per_cluster(posts: DataFrame, num_levels: int) -> DataFrame:
    nodes = level_nodes(posts, num_levels, "url")
    return nodes.groupBy("level", "cluster_id").agg(F.countDistinct("url").alias("urls"))


def size_distribution(posts: DataFrame, num_levels: int) -> DataFrame:
    """Shape of the URLs-per-cluster distribution: near 0 skewness and excess kurtosis is normal."""
    return _urls_per_cluster(posts, num_levels).groupBy("level").agg(
        F.count("*").alias("clusters"),
        F.avg("urls").alias("mean_urls"),
        F.stddev("urls").alias("stddev_urls"),
        F.skewness("urls").alias("skewness"),
        F.kurtosis("urls").alias("kurtosis"),
    )


def site_coverage(posts: DataFrame, num_levels: int, site: str = "site") -> DataFrame:
    """How many clusters of each level draw on two sites or more."""
    nodes = level_nodes(posts, num_levels, site)
    sites = nodes.groupBy("level", "cluster_id").agg(F.countDistinct(site).alias("sites"))
    return sites.groupBy("level").agg(
        F.count("*").alias("clusters"),
        F.count_if(F.col("sites") > 1).alias("shared_clusters"),
        F.avg("sites").alias("mean_sites"),
    )
