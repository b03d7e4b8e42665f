"""Scoring new posts as a stream with the columns and models of the batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topicgrove.operators.classify import TopicModel
from topicgrove.operators.cleaning import read_articles, recent_posts
from topicgrove.operators.embedding import WordEncoder, embed
from topicgrove.operators.review import topic_paths


def clean_stream(posts: DataFrame, min_words: int = 20, max_words: int | None = None, strict: bool = False) -> DataFrame:
    """New posts through every row-wise filter of ``clean_posts``; stateless, so it keeps no rows."""
    return read_articles(recent_posts(posts, strict=strict), min_words, max_words)


def drop_republished(posts: DataFrame, delay: str = "7 days") -> DataFrame:
    """The first post of each URL within ``delay`` of its publication.

    State is kept per URL until the watermark passes it; a copy that comes
    later is a new post, and the batch job remains the authority on duplicates.
    """
    timed = posts.withColumn("published", F.try_to_timestamp("date"))
    return timed.withWatermark("published", delay).dropDuplicatesWithinWatermark(["url"])


def score_stream(
    posts: DataFrame, encoder: WordEncoder, model: TopicModel, tree: DataFrame, num_levels: int
) -> DataFrame:
    """Clean posts with the predicted topic of every level, for a stream or a batch.

    ``tree`` is the static table of topics; each micro-batch joins it afresh.
    """
    return topic_paths(model.predict(embed(posts, encoder)), tree, num_levels)


def write_stream(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append everything that is available to ``path`` exactly once and stop."""
    return (
        rows.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
