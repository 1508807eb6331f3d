"""From raw documents to tokens: language, near-duplicates, benchmark passages, personal data, encoding.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import decontaminate, jaccard_join, language_id, pii_disclosure, sentencepiece_match
from geoloom.llm.tables import small_batches, table
from geoloom.plans.materialize import materialize

#: Below this calibrated probability a document is of no language that was learned.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or of no learned language go; the model learns from all labelled rows."""
    small_batches(spark)
    judged = language_id.identify(docs, language_id.learn(docs))
    return judged.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    small_batches(spark)
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_batches(spark)
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where(F.size("hits") == 0).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are masked in the texts; n_chars follows."""
    small_batches(spark)
    masked = pii_disclosure.sanitise(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """token_ids is added."""
    small_batches(spark)
    return sentencepiece_match.encode(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("contamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("encoding", encode_text),
]

#: The stages can't be put in SQL; tests hold them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
