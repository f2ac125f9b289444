"""The registered queries, one for each operator over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martworks.llm import quality, suffix_tree_lm, toxicity
from martworks.llm.common import read_table
from martworks.llm.decontaminate import contaminated
from martworks.llm.language_id import identify
from martworks.llm.lexical_search import search as lexical_search
from martworks.llm.merkle import document_manifest
from martworks.llm.minhash_dedup import minhash_components
from martworks.llm.oracle import ORACLE_SQL
from martworks.llm.packing import pack
from martworks.llm.sharding import shard_documents
from martworks.llm.surrogates import pseudonymize
from martworks.llm.token_counts import count_tokens
from martworks.llm.topk_search import search


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each contaminated document and benchmark item found in it."""
    return contaminated(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op2_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score_documents(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of their entities."""
    docs = read_table(spark, sf_dir, "documents")
    return pseudonymize(docs.select("doc_id", "text"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(read_table(spark, sf_dir, "documents"), 3, 85, 100)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"), stored=True)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_tree_lm": op2_suffix_tree_lm,
    "op3_toxicity": op3_toxicity,
    "op4_language_id": op4_language_id,
    "op5_token_counts": op5_token_counts,
    "op6_topk_search": op6_topk_search,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_quality": op8_quality,
    "op9_pii_surrogates": op9_pii_surrogates,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_sharding": op12_sharding,
    "op13_merkle_manifest": op13_merkle_manifest,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
