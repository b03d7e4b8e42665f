"""Tags from the title that lies nearest to the middle of its cluster."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.functions.tags import first_n_title_words, summary_input, tag_format
from topicgrove.functions.vectors import distance
from topicgrove.operators.naming.base import Namer
from topicgrove.session import written

TITLE_WORDS = 6


def centroids(rows: DataFrame, key: str = "cluster_id", vector: str = "text_embedding") -> DataFrame:
    """``key, centroid``: mean vector of each cluster, combined in the map tasks."""
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>"))))
    return rows.groupBy(key).agg(mean.alias("centroid"))


def central_titles(titles: DataFrame, vector: str = "text_embedding") -> DataFrame:
    """``cluster_id, title, distance`` of the post nearest to each centroid, ties by ``seq``."""
    middle = written(centroids(titles, vector=vector), "centroids")
    gap = F.round(distance(F.col(vector).cast("array<double>"), F.col("centroid")), 9)
    near = titles.join(middle, "cluster_id").select("cluster_id", "seq", "title", gap.alias("distance"))
    best = near.groupBy("cluster_id").agg(F.min(F.struct("distance", "seq", "title")).alias("best"))
    return best.select("cluster_id", "best.title", "best.distance")


def title_tags(central: DataFrame) -> DataFrame:
    tag = tag_format(first_n_title_words(summary_input(F.col("title")), TITLE_WORDS))
    return central.select("cluster_id", tag.alias("tag"))


def extractive_namer(vector: str = "text_embedding") -> Namer:
    """Posts must carry their embedding; parents are named from their own titles."""

    def leaf(titles: DataFrame) -> DataFrame:
        return title_tags(central_titles(titles, vector))

    return Namer(leaf, lambda titles, children, taken: leaf(titles))
