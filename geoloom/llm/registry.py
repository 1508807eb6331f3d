"""Queries of the corpus operators, by name, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoloom.llm import class_lm, decontaminate, jaccard_join, kd_shards, language_id, permutation_index, perspectives, pii_disclosure, sentencepiece_match, suffix_dedup
from geoloom.llm.tables import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.query(table(spark, sf_dir, "documents"))


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.query(table(spark, sf_dir, "conversations"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard(table(spark, sf_dir, "documents"))


def op6_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_disclosure.query(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_sentencepiece_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_match.encode(docs, digest=True).drop("text")


def op9_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.class_scores(table(spark, sf_dir, "documents"))


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest_neighbours(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language_id": op2_language_id,
    "op3_perspectives": op3_perspectives,
    "op4_decontaminate": op4_decontaminate,
    "op5_kd_shards": op5_kd_shards,
    "op6_pii_disclosure": op6_pii_disclosure,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_sentencepiece_match": op8_sentencepiece_match,
    "op9_class_lm": op9_class_lm,
    "op10_permutation_index": op10_permutation_index,
}

ORACLE_SQL: dict[str, str] = {"op3_perspectives": perspectives.ORACLE_SQL}
