"""Pairs of similar word sets, without comparing all sets that share a word.

Two sets of Jaccard similarity t or more share a word among the rarest few of each. Only those few words of a set, its
prefix, are joined; the place of the shared word and the sizes bound the intersection before sets are compared in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicgrove.functions.tags import tag_words
from topicgrove.operators.quality import level_nodes
from topicgrove.session import written


def _least_shared(own: Column, other: Column, percent: int) -> Column:
    """Words that two sets of these sizes share at least: the rounded up part of percent in 100 + percent of both."""
    return F.ceil((own + other) * percent / F.lit(100.0 + percent) - 1e-9)


def word_set_classes(sets: DataFrame, key: str) -> DataFrame:
    """``key, class_id, words, members`` of ``id, key, words``: equal sets of a key are one class named by its smallest id.

    Null words do not count; empty or null sets and rows without a key have no class.
    """
    different = sets.select("id", key, F.array_sort(F.array_distinct(F.filter("words", lambda w: w.isNotNull()))).alias("words"))
    filled = different.where((F.size("words") > 0) & F.col(key).isNotNull())
    return filled.groupBy(key, "words").agg(F.min("id").alias("class_id"), F.count("*").alias("members"))


def similar_classes(classes: DataFrame, key: str, percent: int) -> DataFrame:
    """``key, first, other, shared, total``: pairs of classes of a key with 100 * shared >= ``percent`` * total words.

    ``first`` is the smaller id, ``total`` the size of the union. ``percent`` is above 0 and at most 100.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100.")
    known = written(classes.select(key, "class_id", "words"), "classes")
    holders = known.select(key, F.explode("words").alias("word")).groupBy(key, "word").agg(F.count("*").alias("holders"))
    each = known.select(key, "class_id", F.size("words").alias("n"), F.explode("words").alias("word")).join(holders, [key, "word"])
    rarest_first = Window.partitionBy(key, "class_id").orderBy("holders", "word")
    placed = each.withColumn("place", F.row_number().over(rarest_first))
    # The intersection with any partner is at least percent of the own size; a word after this place cannot be the first shared one.
    needed = F.ceil(F.col("n") * percent / F.lit(100.0) - 1e-9)
    prefix = written(placed.where(F.col("place") <= F.col("n") - needed + 1).select(key, "class_id", "n", "word", "place"), "prefixes")
    a, b = prefix.alias("a"), prefix.alias("b")
    least = _least_shared(F.col("a.n"), F.col("b.n"), percent)
    left = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place")) + 1
    sizes = (100 * F.col("a.n") >= percent * F.col("b.n")) & (100 * F.col("b.n") >= percent * F.col("a.n"))
    same = (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.word") == F.col("b.word"))
    met = a.join(b, same & (F.col("a.class_id") < F.col("b.class_id")) & sizes)
    # A pair meets once for each shared word of both prefixes; the first one has the smallest places and the loosest bound.
    first = F.min(F.struct("a.place", least.alias("least"), left.alias("left"))).alias("at")
    pairs = met.groupBy(F.col(f"a.{key}").alias(key), F.col("a.class_id").alias("first"), F.col("b.class_id").alias("other")).agg(first)
    possible = pairs.where(F.col("at.left") >= F.col("at.least")).drop("at")
    words = known.select(key, F.col("class_id").alias("first"), F.col("words").alias("first_words"))
    others = known.select(key, F.col("class_id").alias("other"), F.col("words").alias("other_words"))
    shared = F.size(F.array_intersect("first_words", "other_words"))
    compared = possible.join(words, [key, "first"]).join(others, [key, "other"])
    counted = compared.select(key, "first", "other", shared.alias("shared"), (F.size("first_words") + F.size("other_words") - shared).alias("total"))
    return counted.where(100 * F.col("shared") >= percent * F.col("total"))


def similar_tags(posts: DataFrame, num_levels: int, percent: int = 50) -> DataFrame:
    """Pairs of tags of a level whose words are alike, as ``level, first, other, first_clusters, other_clusters, similarity``.

    ``first`` and ``other`` are the smallest cluster ids with the two word sets, the counts say how many clusters have them. A set that several
    clusters have also pairs with itself (``first`` = ``other``), so no copies are expanded into pairs. Tags without words take no part.
    """
    nodes = level_nodes(posts, num_levels).distinct()
    sets = nodes.select(F.col("cluster_id").alias("id"), "level", F.coalesce(tag_words(F.col("tag")), F.array()).alias("words"))
    classes = written(word_set_classes(sets, "level"), "tag-sets")
    pairs = similar_classes(classes, "level", percent)
    members = classes.select("level", F.col("class_id").alias("first"), F.col("members").alias("first_clusters"))
    others = members.select("level", F.col("first").alias("other"), F.col("first_clusters").alias("other_clusters"))
    similarity = (F.col("shared") / F.col("total")).alias("similarity")
    columns = ["level", "first", "other", "first_clusters", "other_clusters"]
    found = pairs.join(members, ["level", "first"]).join(others, ["level", "other"]).select(*columns, similarity)
    same = members.where("first_clusters > 1").select("level", "first", F.col("first").alias("other"), "first_clusters", F.col("first_clusters").alias("other_clusters"))
    return found.unionByName(same.withColumn("similarity", F.lit(1.0)))
