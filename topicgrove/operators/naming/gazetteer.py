"""Tags from the titles of a knowledge table that match a cluster's seed words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicgrove.functions.tags import NO_SEED_TAG, candidate_title, tag_format
from topicgrove.functions.text import clean_html, num_words, word_runs
from topicgrove.operators.naming.base import Namer
from topicgrove.operators.naming.tfidf import seed_words

N_SEEDS = 5
MOST_PHRASES = 4


def best_titles(words: DataFrame, concepts: DataFrame) -> DataFrame:
    """``word, title``: the shortest concept title that holds the word, ties in title order.

    The concept table is cut to the wanted words before it is grouped, and each
    map task keeps one title per word.
    """
    terms = F.explode(F.array_distinct(word_runs(F.lower("title"))))
    index = concepts.select(terms.alias("word"), num_words(F.col("title")).alias("size"), "title")
    wanted = index.join(words.select("word").distinct(), "word", "left_semi")
    return wanted.groupBy("word").agg(F.min(F.struct("size", "title")).alias("best")).select("word", "best.title")


#: From ``word`` rows and concept titles to one ``title`` per ``word``.
TitleSearch = Callable[[DataFrame, DataFrame], DataFrame]


def match_concepts(seeds: DataFrame, concepts: DataFrame, search: TitleSearch = best_titles) -> DataFrame:
    """``cluster_id, tag`` from seed arrays: the four longest titles that ``search`` finds for them, joined."""
    each = seeds.select("cluster_id", F.posexplode_outer("seeds").alias("pos", "word"))
    title = candidate_title(F.col("title"), clean_html)
    matched = each.join(search(each.filter("word IS NOT NULL"), concepts).select("word", "title"), "word", "left")
    phrases = matched.select("cluster_id", "pos", F.when(F.col("title").isNotNull() & (title != ""), title).alias("phrase"))
    order = Window.partitionBy("cluster_id").orderBy(
        F.coalesce(num_words(F.col("phrase")), F.lit(0)).desc(), F.col("pos")
    )
    top = phrases.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= MOST_PHRASES)
    ranked = F.sort_array(F.collect_list(F.when(F.col("phrase").isNotNull(), F.struct("place", "phrase"))))
    tag = tag_format(F.array_join(F.transform("ranked", lambda r: r.phrase), "_"))
    named = top.groupBy("cluster_id").agg(ranked.alias("ranked")).select("cluster_id", tag.alias("tag"))
    return named.withColumn("tag", F.when(F.col("tag") == "", F.lit(NO_SEED_TAG)).otherwise(F.col("tag")))


def gazetteer_namer(concepts: DataFrame, search: TitleSearch = best_titles) -> Namer:
    """Names from ``concepts`` (``title``); parents are named from their titles, not from child tags.

    ``search`` picks a title for a seed word: the shortest one, or the best by rank (``search.ranked_titles``).
    """

    def leaf(titles: DataFrame) -> DataFrame:
        return match_concepts(seed_words(titles, "title", N_SEEDS), concepts, search)

    def parent(titles: DataFrame, children: DataFrame, taken: DataFrame) -> DataFrame:
        unique = titles.select("cluster_id", "title").distinct()
        return match_concepts(seed_words(unique, "title", N_SEEDS, joined_by_mark=False), concepts, search)

    return Namer(leaf, parent)
