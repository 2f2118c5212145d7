"""From raw documents to training sequences: five stages, each written as Parquet and read again by the next.

Every stage works on all rows that the one before kept; all but the last return the columns of ``documents``. A lost
run can go on from the last written stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygauge.llm import decontam, packing, pii, simhash, toxicity
from skygauge.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from all labels of documents at hand."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.classify(docs, model).where(~F.col("rejected")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: four-word shingles, at most four differing bits."""
    return simhash.one_of_each(docs, distance=4, words=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark item."""
    return decontam.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in the place of personal data."""
    found = pii.find(docs)
    masked = found.withColumn("text", pii.masked(found))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids as pieces of sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("benchmark", drop_benchmark),
          ("personal_data", mask_personal_data), ("packing", pack_sequences)]

#: No stage but the third could be written in SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
