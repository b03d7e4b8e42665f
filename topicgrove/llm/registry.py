"""Queries of this part over the given tables, and their SQL checks."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicgrove.llm import oracle
from topicgrove.llm.bpe import digests
from topicgrove.llm.common import bucket_of, shuffle_partitions, table
from topicgrove.llm.decontamination import contamination
from topicgrove.llm.katz import fit_and_score as katz_scores
from topicgrove.llm.mixing import plan
from topicgrove.llm.quality_classifier import fit as fit_quality
from topicgrove.llm.quality_classifier import score as score_quality
from topicgrove.llm.quality_rules import judge
from topicgrove.llm.near_dedup import near_duplicates
from topicgrove.llm.packing import pack
from topicgrove.llm.phrases import collocations
from topicgrove.llm.token_counts import count_tokens
from topicgrove.llm.toxicity import fit as fit_toxicity
from topicgrove.llm.toxicity import score as score_toxicity
from topicgrove.llm.url_filters import judge as judge_urls
from topicgrove.llm.whitening import fit as fit_whitening
from topicgrove.llm.whitening import whiten


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"))
    return judged.withColumn("broken", F.array_join("broken", ","))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plan(table(spark, sf_dir, "documents"))
    each = rows.withColumn("position", F.get("positions", F.lit(0))).withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n_rows"))))
    ordered = each.repartitionByRange(shuffle_partitions(spark), "position", "doc_id").sortWithinPartitions("position", "doc_id")
    return ordered.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (bucket_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op1_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS rules(verdict, host, path)"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), n=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (bucket_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op10_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"), bucket_of(F.col("doc_id"), 7) == 2)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whiten(vectors, fit_whitening(vectors))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).drop("cut")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


#: The rules of the registered query.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

QUERIES = {
    "op2_quality_rules": op2_quality_rules,
    "op3_mixing": op3_mixing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_decontamination": op5_decontamination,
    "op1_token_packing": op1_token_packing,
    "op6_token_counts": op6_token_counts,
    "op7_url_filters": op7_url_filters,
    "op8_near_dedup": op8_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_katz": op10_katz,
    "op11_whitening": op11_whitening,
    "op12_phrases": op12_phrases,
    "op13_bpe": op13_bpe,
}

ORACLE_SQL = {
    "op2_quality_rules": oracle.QUALITY_RULES,
    "op3_mixing": oracle.MIXING,
    "op5_decontamination": oracle.DECONTAMINATION,
    "op7_url_filters": oracle.URL_FILTERS,
    "op8_near_dedup": oracle.NEAR_DEDUP,
    "op12_phrases": oracle.PHRASES,
}
