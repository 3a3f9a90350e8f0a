"""Corpus pipeline: toxicity, line dedup, n-gram near-dedup, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept.  All but the last return the columns of ``documents``; the last
returns the packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import linededup, mixing, ngramjoin, packing, toxicity
from tidemark.llm.common import checkpoint_folder, drop_folder, read_table


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they now are."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the rejection threshold."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; those left without a line go."""
    return _counted(linededup.dedup_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return ngramjoin.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources cut or repeated to their target weights."""
    return _counted(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their place in training sequences."""
    return packing.pack(docs, lean=True)  # the stages before have filled the executors' heaps


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A classifier, prefix-doubling ranks and a tokenizer: SQL cannot express the stages.
# tests/llm holds them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet in the shared checkpoint folder and read again."""
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            drop_folder(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")  # nothing reads it any more
    return docs
