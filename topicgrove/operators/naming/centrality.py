"""Tags from the title whose words are the most central in its cluster's graph of words.

Words that stand side by side in a title of a cluster are joined by an edge, weighted by how often they do. PageRank over these
edges runs for all clusters at once, as joins on numbered words, so a cluster of any size is spread over its words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.functions.tags import NO_SEED_TAG, summary_input
from topicgrove.functions.text import word_runs
from topicgrove.operators.naming.base import Namer
from topicgrove.operators.naming.extractive import title_tags
from topicgrove.session import written

#: How much of a word's rank comes from its neighbours, and how many rounds ranks are passed on.
DAMPING, ROUNDS = 0.85, 10
#: Rounds between two written tables.
WRITE_EVERY = 5
SCORE_DECIMALS = 9


def _with_words(titles: DataFrame) -> DataFrame:
    return titles.where("cluster_id IS NOT NULL").select(
        "cluster_id", "seq", "title", F.coalesce(word_runs(F.lower(summary_input(F.col("title")))), F.array()).alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )


def _word_pairs(worded: DataFrame) -> DataFrame:
    """``cluster_id, low, high, weight``: how often two different words stand side by side."""
    pairs = F.arrays_zip(F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))).alias("a"), F.slice("words", 2, F.size("words")).alias("b"))
    side = worded.where(F.size("words") > 1).select("cluster_id", F.inline(pairs).alias("a", "b")).where("a <> b")
    return side.groupBy("cluster_id", F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).agg(F.count("*").alias("weight"))


def _both_ways(pairs: DataFrame, low: str, high: str, names: tuple[str, str], *kept: str) -> DataFrame:
    ways = [F.struct(F.col(a).alias(names[0]), F.col(b).alias(names[1])) for a, b in ((low, high), (high, low))]
    return pairs.select(*kept, "weight", F.inline(F.array(*ways))).select(*kept, *names, "weight")


def word_edges(worded: DataFrame) -> DataFrame:
    """``cluster_id, word, other, weight``: how often two different words stand side by side, both ways round."""
    return _both_ways(_word_pairs(worded), "low", "high", ("word", "other"), "cluster_id")


def _shares(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """``node, other, share``: the part of a word's rank that each neighbour gets, by numbers of words and dealt by ``node``."""
    for end in ("low", "high"):
        numbers = words.select("cluster_id", F.col("word").alias(end), F.col("node").alias(f"{end}_node"))
        pairs = pairs.join(numbers, ["cluster_id", end]).drop(end)
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = _both_ways(pairs, "low_node", "high_node", ("node", "other")).repartition(parts, "node")
    totals = links.groupBy("node").agg(F.sum("weight").alias("total"))
    return links.join(totals, "node").select("node", "other", (F.col("weight") / F.col("total")).alias("share"))


def _passed_on(shares: DataFrame, ranks: DataFrame | None) -> DataFrame:
    """``node, rank`` after one more round, from ranks of 1 where there are none yet; only what neighbours get is shuffled."""
    got = F.col("share")
    if ranks is not None:
        shares, got = shares.join(ranks, "node"), F.col("share") * F.col("rank")
    passed = shares.groupBy(F.col("other").alias("node")).agg(F.sum(got).alias("got"))
    return passed.select("node", (F.lit(1 - DAMPING) + DAMPING * F.col("got")).alias("rank"))


def word_ranks(worded: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``cluster_id, word, rank`` of all words after ``rounds`` rounds from 1; a word without neighbours keeps 1 - damping.

    Rounds see words by number. The shares of all edges are dealt to partitions once and kept there; edges go both ways, so every
    word with a neighbour is in the result of each round.
    """
    distinct = worded.select("cluster_id", F.explode("words").alias("word")).distinct()
    words = written(distinct.withColumn("node", F.monotonically_increasing_id()), "words")
    if rounds < 1:
        return words.select("cluster_id", "word", F.lit(1.0).alias("rank"))
    shares = _shares(written(_word_pairs(worded), "pairs"), words).persist()
    ranks = None
    for done in range(1, rounds + 1):
        ranks = _passed_on(shares, ranks)
        if done % WRITE_EVERY == 0 or done == rounds:
            ranks = written(ranks, "ranks")
    shares.unpersist()
    rank = F.coalesce("rank", F.lit(1 - DAMPING))
    return words.join(ranks, "node", "left").select("cluster_id", "word", rank.alias("rank"))


def most_central_titles(titles: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``cluster_id, title, score``: the title with the highest mean rank of its words, ties by ``seq``, then by title.

    Titles without words take no part; a cluster that has no others has a null title and score.
    """
    worded = written(_with_words(titles), "worded")
    ranks = word_ranks(worded, rounds)
    # Equal titles have equal scores: one row stands for all, so each is scored once. Titles stay behind until the best are known.
    with_words = worded.where(F.size("words") > 0)
    different = with_words.groupBy("cluster_id", F.md5("title")).agg(F.min("seq").alias("seq"), F.min("row").alias("row"))
    different = written(different.select("cluster_id", "seq", "row"), "different")
    each = with_words.join(different.select("row"), "row", "left_semi").select("cluster_id", "row", F.explode("words").alias("word"))
    means = each.join(ranks, ["cluster_id", "word"]).groupBy("row").agg(F.round(F.avg("rank"), SCORE_DECIMALS).alias("score"))
    scored = written(different.join(means, "row").select("cluster_id", "row", F.struct((-F.col("score")).alias("loss"), "seq").alias("place")), "scored")
    best = scored.groupBy("cluster_id").agg(F.min("place").alias("best"))
    first = written(scored.join(best, "cluster_id").where(F.col("place").eqNullSafe(F.col("best"))).select("row", "place"), "best")
    named = worded.select("cluster_id", "row", "title").join(first, "row").groupBy("cluster_id")
    found = named.agg(F.min("title").alias("title"), F.first("place.loss").alias("loss")).select("cluster_id", "title", (-F.col("loss")).alias("score"))
    return worded.select("cluster_id").distinct().join(found, "cluster_id", "left")


def centrality_namer(rounds: int = ROUNDS) -> Namer:
    """Leaves are named from their titles, parents from the names of their children."""

    def named(titles: DataFrame) -> DataFrame:
        tags = title_tags(most_central_titles(titles, rounds))
        return tags.withColumn("tag", F.when(F.coalesce("tag", F.lit("")) == "", F.lit(NO_SEED_TAG)).otherwise(F.col("tag")))

    def parent(titles: DataFrame, children: DataFrame, taken: DataFrame) -> DataFrame:
        return named(children.select("cluster_id", "seq", F.col("tag").alias("title")))

    return Namer(lambda titles: named(titles), parent)
