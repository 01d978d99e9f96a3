"""The corpus pipeline: STAGES over `documents`, each written as Parquet and reread as the next one's docs.

Every stage works on all rows that the stage before kept, and all but the last return the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick.llm.classifier import score_quality
from yardstick.llm.common import store, table
from yardstick.llm.linededup import dedup_lines
from yardstick.llm.mixing import SHARES, mixed
from yardstick.llm.neardup import kept_documents
from yardstick.llm.packing import pack_stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.5 or more)."""
    return score_quality(docs, docs, table(spark, sf_dir, "labels"), keep_columns=True).where("predicted = 1").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less their repeated lines and passages; every row stays, n_chars follows the text."""
    out = dedup_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, similarity 0.8)."""
    return kept_documents(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out so that any stretch of them has the sources' target shares."""
    return mixed(docs, SHARES)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens, in the order of the mix."""
    return pack_stored(docs)


STAGES = [("quality_classifier", quality_classifier), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("source_mixing", source_mixing), ("packing", packing)]
ORACLE_SQL = None  # trained and hashed stages; tests hold each against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, f"pipeline-{name}")
    return docs
