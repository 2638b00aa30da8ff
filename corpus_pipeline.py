"""Raw documents to packed training sequences, one stored table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdfast.llm.mixing import mixed_documents
from holdfast.llm.packing import pack_documents
from holdfast.llm.quality import SYMBOL_LIMIT, keep_good
from holdfast.llm.rows import documents
from holdfast.llm.secrets import redact_documents
from holdfast.llm.simhash import drop_near_duplicates
from holdfast.session import hand_over, owned_tables, release_stored, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base and repetition rules and hold few symbols, a step of
    its own, since repetition does not find symbol noise."""
    return keep_good(docs, SYMBOL_LIMIT)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id: fingerprints of
    three-word shingles, linked at three or fewer differing bits."""
    return drop_near_duplicates(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts replaced."""
    return redact_documents(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as far as the mix takes their words, repeats in the same row."""
    return mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("mixing_sources", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenizers and 64-bit hashes are beyond SQL; a test compares the chain with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again by the next.

    What a stage stores for itself goes when its result is stored, and that result when the
    next one is, so the disk holds one stage's tables at a time.
    """
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        with owned_tables() as inner:
            plan = stage(spark, docs, sf_dir)
        with owned_tables() as result:
            docs = store(plan, name)
        release_stored(spark, inner + before)
        before = result
    hand_over(before)  # the last stage's plan reads it
    return STAGES[-1][1](spark, docs, sf_dir)
