"""Registered queries of the training-data operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import embdedup, langid, linededup, mixing, ngramjoin, packing, periodic, quality, revisit, tokencount, topk, toxicity, whitening
from tidemark.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and near-duplicate component of every document."""
    return ngramjoin.jaccard_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, grade and rejection of every document."""
    return toxicity.grade(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    return embdedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a packed sequence."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best matches of every embedding whose id 50 divides."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix_plan(read_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before and after line dedup, and the digest of what is kept."""
    return linededup.line_report(read_table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op10_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome, stored response and effective headers of every capture of ``pages``."""
    return revisit.resolve_pages(read_table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokencount.token_counts(read_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document with planted tails, and what is left without repetitions."""
    return periodic.run_report(periodic.with_planted_tail(read_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_packing": op5_packing,
    "op6_topk": op6_topk,
    "op7_mixing": op7_mixing,
    "op8_line_dedup": op8_line_dedup,
    "op9_langid": op9_langid,
    "op10_revisit": op10_revisit,
    "op11_whitening": op11_whitening,
    "op12_token_counts": op12_token_counts,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op6_topk": topk.ORACLE_SQL,
    "op7_mixing": mixing.ORACLE_SQL,
    "op10_revisit": revisit.ORACLE_SQL,
}
