"""Documents to training samples: quality, near-duplicates, benchmark passages, personal data, sampled pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skeinworks.llm import decontamination, near_dedup, piece_sampling, pii, quality_net
from skeinworks.llm._common import delete, new_folder, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the network does not reject."""
    return quality_net.keep_good(docs, quality_net.fitted(spark, sf_dir))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.drop_near_duplicates(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a benchmark passage."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data and the terms that disclose it rewritten."""
    return pii.sanitise(docs, count_col="n_chars")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every text."""
    return piece_sampling.sample(docs)


STAGES = [("quality", good), ("near_dedup", distinct), ("decontamination", clean), ("pii", private), ("pieces", pieces)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again; a stage's table goes once the next one's stands. What the last stage
    reads stays, for its rows are computed when they are asked for."""
    docs = table(spark, sf_dir, "documents")
    folder, before = new_folder(spark, "pipeline"), None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
