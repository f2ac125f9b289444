"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.llm import decontaminate, minhash_dedup, packing, surrogates, toxicity
from martworks.llm.common import read_table, staged
from martworks.session import remove_path, scratch, work_path


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.clean_documents(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, Jaccard 0.8)."""
    return minhash_dedup.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities become surrogates; n_chars follows the new text."""
    out = surrogates.pseudonymize(docs)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return out.withColumn("n_chars", length.cast(kind))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("pack", pack),
]

#: SQL cannot express the model and the alignment stages; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table.

    Each stage's rows are written before the next one reads them; what a stage staged on the
    way, and the rows it read, are removed as soon as its own are written. Null and empty texts
    and repeated rows go through every stage as its operator defines; an empty table stays so.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = work_path(spark, name)
        with scratch(spark):
            docs = staged(stage(spark, docs, sf_dir), name, path=path)
        if before:
            remove_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
