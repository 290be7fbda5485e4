"""Corpus pipeline: five stages over documents, each calling one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the
columns of documents. The first three drop rows, the fourth rewrites texts,
the last returns one row per packed piece.

Null or repeated ids and empty tables need no care of the caller: toxicity and
decontamination judge rows by their own text, and of a group of near
duplicates exactly one row stays, the first by (doc_id, text), nulls last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, packing, secret_scan, simhash, toxicity
from quarry.session import scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced by a mark; n_chars follows the new text."""
    return docs.withColumn("text", secret_scan.redacted(F.col("text"))) \
        .withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                    .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its sequence and offset."""
    return packing.best_fit_packing(docs)


STAGES = [("toxicity", toxicity_stage), ("simhash", simhash_stage), ("decontamination", decontamination_stage),
          ("secrets", secrets_stage), ("packing", packing_stage)]

#: Embedded classifiers, bit-majority fingerprints and packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; every result but the last is written to the
    shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
