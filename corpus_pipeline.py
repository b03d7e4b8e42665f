"""The training-data pipeline: quality, near-duplicates, decontamination, mixture, packed token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from topicgrove.llm.common import table
from topicgrove.llm.decontamination import decontaminated
from topicgrove.llm.mixing import training_order
from topicgrove.llm.near_dedup import one_of_each
from topicgrove.llm.packing import pack
from topicgrove.llm.quality_classifier import accepted, fit
from topicgrove.session import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier, fitted on the labelled ones among them, rejects."""
    return accepted(docs, fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: five words, similarity 0.8 or more."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources come near their targets, in training order."""
    return training_order(docs).select([f"`{c}`" for c in docs.columns])


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of packed token ids, shards in the order of the written mixture."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), in_order=True)


STAGES = [
    ("quality_classifier", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_packing", pack_tokens),
]

#: The first and the last stage cannot be written in SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
