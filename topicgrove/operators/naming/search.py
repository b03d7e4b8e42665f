"""Ranked search over the titles of a knowledge table (BM25).

The table is read as an inverted index: a posting is a word, a title, how often the word stands in it, and the title's length.
Only postings of words that are asked for are kept. Queries of one word need one aggregate. Queries of several words first
learn from the best posting of each word which words can carry the best title at all; the postings of the others, which
are the common ones, are looked up for titles that are already candidates and never joined as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicgrove.functions.text import word_runs
from topicgrove.session import written
from topicgrove.sources.posts import with_seq

#: How soon repeats of a word stop counting, and how much long titles are held back.
SATURATION, LENGTH_WEIGHT = 1.2, 0.75
#: Decimals of a score; equal scores go to the shorter title, then to the smaller one.
SCORE_DECIMALS = 9
#: Half a unit of the last decimal a word is far below this slack; it only lets more candidates in.
SLACK = 1e-6


def postings(words: DataFrame, concepts: DataFrame) -> DataFrame:
    """``word, title, length, score`` of the wanted ``words`` in different titles of ``concepts``.

    The score is BM25 of one word. A title that is repeated counts once, a null one or one without words not at all.
    """
    titles = concepts.select("title").distinct().withColumn("words", word_runs(F.lower("title")))
    index = written(titles.select("title", "words", F.size("words").alias("length")).where("length > 0"), "titles")
    total = index.agg(F.count("*").cast("double").alias("titles"), F.avg("length").alias("usual"))
    wanted = words.where("word IS NOT NULL").select("word").distinct()
    each = index.select("title", "length", F.explode("words").alias("word")).join(wanted, "word", "left_semi")
    counted = written(each.groupBy("word", "title", "length").agg(F.count("*").alias("times")), "postings")
    holders = counted.groupBy("word").agg(F.count("*").alias("holders"))
    known = counted.join(holders, "word").join(F.broadcast(total))  # one row
    rarity = F.log(1 + (F.col("titles") - F.col("holders") + 0.5) / (F.col("holders") + 0.5))
    held_back = SATURATION * (1 - LENGTH_WEIGHT + LENGTH_WEIGHT * F.col("length") / F.col("usual"))
    score = rarity * F.col("times") * (SATURATION + 1) / (F.col("times") + held_back)
    return known.select("word", "title", "length", F.round(score, SCORE_DECIMALS).alias("score"))


def _best(scored: DataFrame, key: str) -> DataFrame:
    first = F.min(F.struct((-F.col("score")).alias("loss"), "length", "title")).alias("best")
    return scored.groupBy(key).agg(first).select(key, "best.title", (-F.col("best.loss")).alias("score"))


def ranked_titles(words: DataFrame, concepts: DataFrame) -> DataFrame:
    """``word, title, score``: the best title of each ``word``; each map task keeps one posting per word."""
    return _best(postings(words, concepts), "word")


def best_title_of_words(queries: DataFrame, concepts: DataFrame) -> DataFrame:
    """``query_id, title, score``: the title with the largest sum of scores over the query's different words.

    ``queries`` has ``query_id, words``. A query none of whose words is in any title has no row.

    The best posting of one word is a score that some title reaches. Words in rising order of their best posting cannot
    reach it together up to some place: a title with those words alone is never the best one, so candidates are titles
    of the words after that place only. Of these, only titles that the other words can still lift to the best one's carried score
    are looked up for the other words.
    """
    asked = written(queries.select("query_id", F.explode(F.array_distinct("words")).alias("word")).where("word IS NOT NULL"), "asked")
    index = written(postings(asked, concepts), "index")
    tops = index.groupBy("word").agg(F.max("score").alias("top"))
    rising = Window.partitionBy("query_id").orderBy("top", "word")
    bounds = asked.join(tops, "word").select(
        "query_id", "word", "top", F.sum("top").over(rising).alias("reach"), F.max("top").over(Window.partitionBy("query_id")).alias("reached")
    )
    bounds = written(bounds, "bounds")
    apart = F.col("reach") >= F.col("reached") - SLACK
    carrying = bounds.where(apart)
    others = bounds.where(~apart)
    # What the words before that place can add to any title at the most.
    rest = others.groupBy("query_id").agg(F.max("reach").alias("rest"))
    numbered = written(with_seq(index.select("title", "length").distinct(), "length", "title").withColumnRenamed("seq", "number"), "numbered")
    short = written(index.join(numbered.select("title", "number"), "title").select("word", "number", "score"), "short-index")
    # Titles go by number, in the order that ties are settled in; each with the scores of the words that carry.
    carried = carrying.select("query_id", "word").join(short, "word").groupBy("query_id", "number").agg(F.sum("score").alias("carried"))
    carried = written(carried, "carried")
    best = carried.groupBy("query_id").agg(F.max("carried").alias("most")).join(rest, "query_id", "left")
    within = F.col("carried") + F.coalesce("rest", F.lit(0.0)) >= F.col("most") - SLACK
    candidates = written(carried.join(best, "query_id").where(within).select("query_id", "number", "carried"), "candidates")
    pairs = candidates.select("query_id", "number").join(others.select("query_id", "word"), "query_id")
    looked_up = pairs.join(short, ["word", "number"]).select("query_id", "number", "score")
    parts = candidates.select("query_id", "number", F.col("carried").alias("score")).unionByName(looked_up)
    scored = parts.groupBy("query_id", "number").agg(F.round(F.sum("score"), SCORE_DECIMALS).alias("score"))
    first = F.min(F.struct((-F.col("score")).alias("loss"), "number")).alias("best")
    found = scored.groupBy("query_id").agg(first).select("query_id", F.col("best.number").alias("number"), (-F.col("best.loss")).alias("score"))
    return found.join(numbered.select("number", "title"), "number").select("query_id", "title", "score")
