"""Tags from the most frequent words of titles and child tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicgrove.functions.tags import NO_KEYWORD_TAG, NO_PARENT_TAG, keyword_words, tag_words
from topicgrove.operators.naming.base import Namer
from topicgrove.operators.naming.unique import unique_tags

LEAF_SIZES = [2, 3, 4, 5, 6]
PARENT_SIZES = [1, 3, 4, 5, 6]
MOST_WORDS = 6
LAST_RESORT = "_7"


def word_counts(rows: DataFrame, words: Column) -> DataFrame:
    """``cluster_id, word, count, first_place`` over rows with ``cluster_id, seq``; a place is ``(seq, pos)``.

    A cluster without words keeps one row with a null word. Counts are combined
    in each map task, so a dominant cluster sends one row per word and task.
    """
    each = rows.select("cluster_id", "seq", F.posexplode_outer(words).alias("pos", "word"))
    place = F.struct("seq", F.coalesce("pos", F.lit(0)).alias("pos"))
    return each.groupBy("cluster_id", "word").agg(
        F.count("word").alias("count"), F.min(place).alias("first_place")
    )


def most_common(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent words of each cluster, ties by first appearance, as ``place``."""
    best = Window.partitionBy("cluster_id").orderBy(
        F.col("word").isNull(), F.col("count").desc(), F.col("first_place")
    )
    return counts.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)


def tag_candidates(counts: DataFrame, sizes: list[int]) -> DataFrame:
    """Ranked tag candidates per cluster; none for a cluster without words."""
    ranked = F.sort_array(F.collect_list(F.struct("place", "word")))
    words = F.filter(F.transform(ranked, lambda r: r.word), lambda w: w.isNotNull())
    joined = [F.array_join(F.slice("words", 1, size), "_") for size in sizes]
    last = F.concat(joined[-1], F.lit(LAST_RESORT))
    found = F.when(F.size("words") > 0, F.array(*joined, last))
    top = most_common(counts, MOST_WORDS).groupBy("cluster_id").agg(words.alias("words"))
    return top.select("cluster_id", found.alias("candidates"))


def _settle(candidates: DataFrame, taken: DataFrame | None, nothing: str) -> DataFrame:
    """Unique tags; a cluster without candidates gets ``nothing``, which any number may share."""
    only = F.array(F.lit(nothing))
    return unique_tags(candidates.withColumn("candidates", F.coalesce("candidates", only)), taken)


def leaf_candidates(titles: DataFrame) -> DataFrame:
    return tag_candidates(word_counts(titles, keyword_words(F.col("title"))), LEAF_SIZES)


def parent_candidates(children: DataFrame) -> DataFrame:
    return tag_candidates(word_counts(children, tag_words(F.col("tag"))), PARENT_SIZES)


def leaf_tags(titles: DataFrame) -> DataFrame:
    """The two most frequent title words, more words where that tag is already given."""
    return _settle(leaf_candidates(titles), None, NO_KEYWORD_TAG)


def parent_tags(titles: DataFrame, children: DataFrame, taken: DataFrame) -> DataFrame:
    """The most frequent word of the child tags, more words where that tag is already given.

    A child that has no tag words of its own does not reserve its tag.
    """
    reserved = taken.filter(~F.col("tag").isin(NO_KEYWORD_TAG, NO_PARENT_TAG))
    return _settle(parent_candidates(children), reserved, NO_PARENT_TAG)


KEYWORD_NAMER = Namer(leaf_tags, parent_tags)
