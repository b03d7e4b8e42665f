"""Tags from a text generator that the user supplies."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.functions.tags import leaf_prompt, parent_prompt, reply_tag, reply_topic
from topicgrove.operators.naming.base import Namer
from topicgrove.operators.naming.keyword import KEYWORD_NAMER
from topicgrove.session import written

Generator = Callable[[pd.Series, pd.Series], pd.Series]

# Titles or tags in one prompt, on average: how much is put together, not how much is read.
ITEMS_PER_PROMPT = 10
NO_REPLY_TAG = "error_tag"


def sliced(rows: DataFrame, item: str, order: str, size: int = ITEMS_PER_PROMPT) -> DataFrame:
    """``cluster_id, slice, slices, items``: every item of each cluster, dealt to slices of about ``size`` by a hash of ``order``.

    A cluster of any size so makes prompts of a bounded length, and no task sees more of it than a slice. Items stand in
    ``order`` inside their slice.
    """
    counts = rows.groupBy("cluster_id").agg(F.ceil(F.count("*") / size).alias("slices"))
    digits = F.substring(F.md5(F.col("at").cast("string")), 1, 8)
    dealt = rows.select("cluster_id", F.col(item).alias("item"), F.col(order).alias("at")).join(counts, "cluster_id").select(
        "cluster_id", "slices", (F.conv(digits, 16, 10).cast("long") % F.col("slices")).alias("slice"), "item", "at"
    )
    ranked = F.sort_array(F.collect_list(F.struct("at", "item")))
    return dealt.groupBy("cluster_id", "slice", "slices").agg(F.transform(ranked, lambda r: r.item).alias("items"))


def title_slices(titles: DataFrame) -> DataFrame:
    return sliced(titles, "title", "seq")


def tag_slices(children: DataFrame) -> DataFrame:
    """The different child tags of each cluster."""
    return sliced(children.select("cluster_id", "tag").distinct(), "tag", "tag")


def ask_once(slices: DataFrame, prompt: Callable, generator: Generator, temperature: float) -> DataFrame:
    """``cluster_id, tag``: one answer to each slice, written, since asking twice may answer twice."""
    ask = F.pandas_udf(generator, "string").asNondeterministic()
    reply = ask(prompt(F.col("items"), F.lit(None).cast("string")), F.lit(temperature))
    answered = slices.select("cluster_id", reply.alias("reply"))
    tag = F.when(F.col("reply").isNull(), F.lit(NO_REPLY_TAG)).otherwise(reply_tag(reply_topic(F.col("reply"))))
    return written(answered.select("cluster_id", tag.alias("tag")), "answers")


def tags_over_slices(
    slices: DataFrame, prompt: Callable, generator: Generator, taken: DataFrame | None, temperature: float, max_rounds: int
) -> DataFrame:
    """``cluster_id, tag``: clusters of one slice are asked for a tag; of the others each slice is, and their tags become the
    next level's items, until one slice is left."""
    settled: DataFrame | None = None
    while True:
        slices = written(slices, "slices")
        whole = slices.filter("slices = 1").select("cluster_id", "items")
        tags = generate_tags(whole, prompt, generator, taken, temperature, max_rounds)
        settled = tags if settled is None else settled.union(tags)
        several = slices.filter("slices > 1")
        if several.isEmpty():
            return settled
        taken = settled.select("tag") if taken is None else taken.select("tag").union(tags.select("tag"))
        slices = tag_slices(ask_once(several, prompt, generator, temperature))
        prompt = parent_prompt


def generate_tags(
    items: DataFrame,
    prompt: Callable,
    generator: Generator,
    taken: DataFrame | None = None,
    temperature: float = 0.2,
    max_rounds: int = 20,
) -> DataFrame:
    """``cluster_id, tag`` from ``cluster_id, items``.

    ``generator(prompts, temperatures)`` answers a batch of prompts. A cluster
    whose tag is already given asks again, with the tag excluded and a
    temperature 0.1 higher (at most 1). Each round is written before it is
    judged, since asking twice may answer twice. A cluster that still collides
    after ``max_rounds`` gets its id appended.
    """
    ask = F.pandas_udf(generator, "string").asNondeterministic()
    pending = items.select("cluster_id", "items", F.lit(None).cast("string").alias("excluded"), F.lit(temperature).alias("temperature"))
    given: list[DataFrame] = [] if taken is None else [taken.select("tag")]
    settled: list[DataFrame] = []
    for _ in range(max_rounds):
        reply = ask(prompt(F.col("items"), F.col("excluded")), F.col("temperature"))
        asked = pending.withColumn("reply", reply)
        tag = F.when(F.col("reply").isNull(), F.lit(NO_REPLY_TAG)).otherwise(reply_tag(reply_topic(F.col("reply"))))
        answered = written(asked.withColumn("tag", tag), "answers")
        open_tags = answered.select("cluster_id", "tag")
        for used in given:
            open_tags = open_tags.join(used.distinct(), "tag", "left_anti")
        won = written(open_tags.groupBy("tag").agg(F.min("cluster_id").alias("cluster_id")).select("cluster_id", "tag"), "tags")
        settled.append(won)
        given.append(won.select("tag"))
        pending = answered.join(won.select("cluster_id"), "cluster_id", "left_anti").select(
            "cluster_id",
            "items",
            F.col("tag").alias("excluded"),
            F.least(F.lit(1.0), F.col("temperature") + 0.1).alias("temperature"),
        )
        if pending.isEmpty():
            break
    else:
        numbered = F.concat_ws("_", F.col("excluded"), F.col("cluster_id").cast("string"))
        settled.append(pending.select("cluster_id", numbered.alias("tag")))
    result = settled[0]
    for part in settled[1:]:
        result = result.union(part)
    return result


def generative_namer(generator: Generator | None = None, temperature: float = 0.2, max_rounds: int = 20) -> Namer:
    """Generated names, or keyword names when there is no generator."""
    if generator is None:
        return KEYWORD_NAMER

    def leaf(titles: DataFrame) -> DataFrame:
        return tags_over_slices(title_slices(titles), leaf_prompt, generator, None, temperature, max_rounds)

    def parent(titles: DataFrame, children: DataFrame, taken: DataFrame) -> DataFrame:
        return tags_over_slices(tag_slices(children), parent_prompt, generator, taken, temperature, max_rounds)

    return Namer(leaf, parent)
