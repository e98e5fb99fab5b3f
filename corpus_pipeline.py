"""The corpus pipeline: from ``documents`` to packed training sequences.

Each stage is ``(name, function)``; a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
documents.  All but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickweave.llm.common import documents, written
from tickweave.llm.exact_dedup import drop_exact_duplicates
from tickweave.llm.packing import pack_documents
from tickweave.llm.repetition import drop_repetitive
from tickweave.llm.secret_ledger import mask_secrets
from tickweave.llm.simhash import drop_near_duplicates

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with few words or much repetition go."""
    return drop_repetitive(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space one stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links one stays."""
    return drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; no document goes."""
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence."""
    return pack_documents(docs, VOCABULARY, END_ID)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Suffix arrays, SimHash and tokenizers have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of a folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
