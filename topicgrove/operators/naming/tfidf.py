"""Tags from the terms that set a cluster apart from the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicgrove.functions.tags import (
    ENGLISH_STOP_WORDS,
    NO_SEED_TAG,
    drop_insignificant_words,
    drop_words_with_digits,
    join_name,
    name_tokens,
    seed_tokens,
)
from topicgrove.functions.text import strip_ws
from topicgrove.operators.naming.base import Namer
from topicgrove.session import written

# Fixed value: words per name.
NAME_WORDS = 4


def term_counts(rows: DataFrame, text: str, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """``cluster_id, term, tf, texts, filled`` over rows of ``cluster_id, <text>``.

    All texts of a cluster make up its document, which is never put together:
    counting terms needs no document. ``texts`` and ``filled`` tell whether the
    document would be blank; a cluster without terms keeps a row with a null term.
    """
    read = rows.select(
        "cluster_id",
        (strip_ws(F.translate(text, "_", " ")) != "").alias("filled"),
        seed_tokens(F.col(text), stop_words).alias("terms"),
    )
    # Explode the terms alone: next to the text, every term would carry a copy of it.
    each = read.select("cluster_id", "filled", F.posexplode_outer("terms").alias("pos", "term"))
    starts = F.when(F.coalesce("pos", F.lit(0)) == 0, 1).otherwise(0)
    return each.groupBy("cluster_id", "term").agg(
        F.count("term").alias("tf"), F.sum(starts).alias("texts"), F.max("filled").alias("filled")
    )


def count_documents(counts: DataFrame, joined_by_mark: bool) -> DataFrame:
    """One row ``n``: clusters whose document is not blank.

    Two texts joined by a visible mark are never blank together.
    """
    each = counts.groupBy("cluster_id").agg(F.sum("texts").alias("texts"), F.max("filled").alias("filled"))
    several = (F.col("texts") > 1) if joined_by_mark else F.lit(False)
    return each.filter(several | F.col("filled")).agg(F.count("*").alias("n"))


def vocabulary(counts: DataFrame, size: int | None = None) -> DataFrame:
    """All terms over all clusters with their document counts, or the ``size`` most frequent ones, ties in term order."""
    totals = counts.filter(F.col("term").isNotNull()).groupBy("term").agg(
        F.sum("tf").alias("total"), F.count("*").alias("df")
    )
    return totals if size is None else totals.orderBy(F.col("total").desc(), "term").limit(size)


def seeds_from_counts(
    counts: DataFrame, n_seeds: int, joined_by_mark: bool = True, vocabulary_size: int | None = None
) -> DataFrame:
    """``cluster_id, place, term, score``: the best terms of each cluster.

    Norms are map-side sums, and the ranking keeps ``n_seeds`` rows per cluster in each map task.
    """
    n = count_documents(counts, joined_by_mark).scalar()
    idf = F.log((1 + n) / (1 + F.col("df"))) + 1
    words = vocabulary(counts, vocabulary_size).select("term", idf.alias("idf"))
    weight = F.col("tf") * F.col("idf")
    scored = counts.join(words, "term").select("cluster_id", "term", weight.alias("weight"))
    norms = scored.groupBy("cluster_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.col("weight").desc(), F.col("term").desc()))
    best = scored.withColumn("place", place).filter(F.col("place") <= n_seeds)
    return best.join(norms, "cluster_id").select("cluster_id", "place", "term", (F.col("weight") / F.col("norm")).alias("score"))


def seed_words(rows: DataFrame, text: str, n_seeds: int = 5, joined_by_mark: bool = True) -> DataFrame:
    """One row per cluster with its seed terms as an array, best first (empty when it has none)."""
    counts = written(term_counts(rows, text), "terms")
    seeds = seeds_from_counts(counts, n_seeds, joined_by_mark)
    listed = seeds.groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("place", "term"))).alias("ranked"))
    everyone = counts.select("cluster_id").distinct()
    words = F.transform(F.coalesce("ranked", F.array()), lambda r: r.term)
    return everyone.join(listed, "cluster_id", "left").select("cluster_id", words.alias("seeds"))


def names_from_seeds(seeds: DataFrame, n_words: int = NAME_WORDS) -> DataFrame:
    """``cluster_id, tag`` from seed arrays; names may repeat."""
    named = seeds.select("cluster_id", join_name(F.col("seeds"), n_words).alias("tag"))
    return named.withColumn("tag", F.when(F.col("tag") == "", F.lit(NO_SEED_TAG)).otherwise(F.col("tag")))


def tfidf_namer(n_words: int = NAME_WORDS) -> Namer:
    def leaf(titles: DataFrame) -> DataFrame:
        return names_from_seeds(seed_words(titles, "title", n_words), n_words)

    def parent(titles: DataFrame, children: DataFrame, taken: DataFrame) -> DataFrame:
        return names_from_seeds(seed_words(children, "tag", n_words, joined_by_mark=False), n_words)

    return Namer(leaf, parent)


def clean_title_terms(rows: DataFrame, text: str, key: str, lemmas: DataFrame | None = None) -> DataFrame:
    """Significant words of each text in order: ``key, words``.

    Stop words, words that say little and words with digits are dropped. With a
    ``lemmas`` table (``word, lemma``) each word is replaced by its lemma first.
    """
    def tidy(words):
        return F.array_join(drop_words_with_digits(drop_insignificant_words(words)), " ")

    if lemmas is None:
        return rows.select(key, tidy(name_tokens(F.col(text))).alias("words"))
    each = rows.select(key, F.posexplode_outer(name_tokens(F.col(text))).alias("pos", "word"))
    lemma = F.coalesce(F.col("lemma"), F.col("word"))
    listed = (
        each.join(lemmas, "word", "left")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("pos", lemma.alias("word"))))).alias("ranked"))
    )
    return listed.select(key, tidy(F.transform("ranked", lambda r: r.word)).alias("words"))
