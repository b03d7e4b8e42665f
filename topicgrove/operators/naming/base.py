"""What all namers share: the naming loop over levels, tag attachment, renaming."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.schema import cluster_column, cluster_columns, require_levels, tag_column
from topicgrove.session import written

Tags = DataFrame
LeafNamer = Callable[[DataFrame], Tags]
ParentNamer = Callable[[DataFrame, DataFrame, DataFrame], Tags]


@dataclass(frozen=True)
class Namer:
    """A pair of functions that name clusters.

    ``leaf(titles)`` gets ``cluster_id, seq, title`` plus any further post
    columns. ``parent(titles, child_tags, taken)`` also gets the child tags of
    each cluster (``cluster_id, seq, tag``; ``seq`` is where the tag is first
    seen) and all tags given on deeper levels (``tag``). Both return
    ``cluster_id, tag``.
    """

    leaf: LeafNamer
    parent: ParentNamer


def titles_of_level(posts: DataFrame, level: int) -> DataFrame:
    """Posts with the id of their cluster at ``level`` as ``cluster_id``."""
    column = F.col(cluster_column(level))
    return posts.filter(column.isNotNull()).withColumn("cluster_id", column)


def cluster_tree(posts: DataFrame, num_levels: int) -> DataFrame:
    """One row per combination of cluster ids, with the first ``seq`` of each."""
    return posts.groupBy(*cluster_columns(num_levels)).agg(F.min("seq").alias("seq"))


def child_tags(tree: DataFrame, tags: Tags, level: int) -> DataFrame:
    """Distinct tags of the children of each cluster at ``level``, with their first ``seq``."""
    child = tags.select(F.col("cluster_id").alias(cluster_column(level + 1)), "tag")
    return (
        tree.join(child, cluster_column(level + 1))
        .filter(F.col(cluster_column(level)).isNotNull())
        .groupBy(F.col(cluster_column(level)).alias("cluster_id"), "tag")
        .agg(F.min("seq").alias("seq"))
    )


def attach_tags(posts: DataFrame, tags: Tags, level: int) -> DataFrame:
    """Set the tag column of a level; a column from an earlier naming is replaced."""
    named = tags.select(F.col("cluster_id").alias(cluster_column(level)), F.col("tag").alias(tag_column(level)))
    return posts.drop(tag_column(level)).join(named, cluster_column(level), "left")


def tags_by_level(posts: DataFrame, num_levels: int, namer: Namer) -> dict[int, Tags]:
    """Tag tables of all levels, named from the finest level up."""
    require_levels(posts, num_levels)
    tree = written(cluster_tree(posts, num_levels), "tree")
    tags = {num_levels: written(namer.leaf(titles_of_level(posts, num_levels)), "tags")}
    taken = tags[num_levels].select("tag")
    for level in range(num_levels - 1, 0, -1):
        children = child_tags(tree, tags[level + 1], level)
        tags[level] = written(namer.parent(titles_of_level(posts, level), children, taken), "tags")
        taken = taken.union(tags[level].select("tag"))
    return tags


def name_clusters(posts: DataFrame, num_levels: int, namer: Namer) -> DataFrame:
    """Posts with one tag column per level.

    The tag tables are written first, so their size is known: a small one is
    broadcast to the posts, a large one is joined by a shuffle that splits
    dominant clusters.
    """
    named = posts
    for level, tags in tags_by_level(posts, num_levels, namer).items():
        named = attach_tags(named, tags, level)
    return named


def rename_cluster(posts: DataFrame, level: int, cluster_id: int, new_name: str) -> DataFrame:
    """Give one cluster another tag."""
    chosen = F.col(cluster_column(level)) == cluster_id
    renamed = F.when(chosen, F.lit(new_name)).otherwise(F.col(tag_column(level)))
    return posts.withColumn(tag_column(level), renamed)


def rename_clusters(posts: DataFrame, level: int, names: Tags) -> DataFrame:
    """Give many clusters another tag; ``names`` has ``cluster_id, tag``."""
    column, new = tag_column(level), "_new_tag"
    listed = names.select(F.col("cluster_id").alias(cluster_column(level)), F.col("tag").alias(new))
    joined = posts.join(listed, cluster_column(level), "left")
    return joined.withColumn(column, F.coalesce(F.col(new), F.col(column))).drop(new)
