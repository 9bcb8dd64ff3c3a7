"""The corpus pipeline: quality rules, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; ``run`` applies them in order to the documents table. Null
and empty texts have no words and go in the first stage; other special cases
are those of the stages' operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscore.llm import byte_bpe, host_quality, order_minhash, suffix_decontam
from loanscore.llm.common import table
from loanscore.llm.queries import BPE_RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host passes."""
    return host_quality.judge_documents(docs).where("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id."""
    return order_minhash.near_duplicates(docs).where("kept").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verbatim benchmark passage."""
    found = suffix_decontam.search_documents(docs, table(spark, sf_dir, "benchmark"))
    return found.where("NOT contaminated").select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each document: its token count and the digests of its ids and of the decoded bytes."""
    path, pattern = public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN
    coded = byte_bpe.decode(byte_bpe.encode(docs.select("doc_id", "text"), path, pattern), path, pattern)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Near-dedup cannot be expressed in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
