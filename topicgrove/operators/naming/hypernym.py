"""Tags from the broader terms of a cluster's seed words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicgrove.functions.tags import NO_SEED_TAG, tag_format
from topicgrove.functions.vectors import cosine
from topicgrove.operators.naming.base import Namer
from topicgrove.operators.naming.tfidf import seed_words

REPORTED = 10


def broader_terms(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``word, lemma``: all lemmas of each word's first sense.

    ``lexicon`` has ``word, sense_rank, lemma``.
    """
    first = lexicon.filter(F.col("sense_rank") == 1).select("word", "lemma").distinct()
    return first.join(words.select("word").distinct(), "word", "left_semi")


def rank_hypernyms(
    seeds: DataFrame, lexicon: DataFrame, vectors: DataFrame | None = None, lexical_weight: float = 0.5
) -> DataFrame:
    """``cluster_id, place, lemma, score``: the ten best broader terms of each cluster.

    A candidate's score is its mean likeness to the cluster's seeds: the
    edit-distance ratio, or with ``vectors`` (``word, vector``) its weighted mean
    with the cosine. All broader terms are scored before the best are kept.
    """
    each = seeds.select("cluster_id", F.explode("seeds").alias("word"))
    candidates = each.join(broader_terms(each, lexicon), "word").select("cluster_id", "lemma").distinct()
    pairs = candidates.join(each, "cluster_id")
    longest = F.greatest(F.length("lemma"), F.length("word"))
    score = 1 - F.levenshtein("lemma", "word") / longest
    if vectors is not None:
        a = vectors.select(F.col("word").alias("lemma"), F.col("vector").alias("_a"))
        b = vectors.select("word", F.col("vector").alias("_b"))
        pairs = pairs.join(a, "lemma", "left").join(b, "word", "left")
        meaning = F.coalesce(cosine(F.col("_a"), F.col("_b")), F.lit(0.0))
        score = lexical_weight * score + (1 - lexical_weight) * meaning
    scored = pairs.groupBy("cluster_id", "lemma").agg(F.round(F.avg(score), 9).alias("score"))
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.col("score").desc(), "lemma"))
    return scored.withColumn("place", place).filter(F.col("place") <= REPORTED)


def hypernym_tags(seeds: DataFrame, ranked: DataFrame) -> DataFrame:
    best = ranked.filter("place = 1").select("cluster_id", tag_format(F.col("lemma")).alias("found"))
    tag = F.coalesce(F.col("found"), F.lit(NO_SEED_TAG)).alias("tag")
    return seeds.join(best, "cluster_id", "left").select("cluster_id", tag)


def hypernym_namer(lexicon: DataFrame, n_seeds: int = 5, vectors: DataFrame | None = None) -> Namer:
    def name(rows: DataFrame, text: str, joined_by_mark: bool) -> DataFrame:
        seeds = seed_words(rows, text, n_seeds, joined_by_mark)
        return hypernym_tags(seeds, rank_hypernyms(seeds, lexicon, vectors))

    return Namer(
        lambda titles: name(titles, "title", True),
        lambda titles, children, taken: name(children, "tag", False),
    )
