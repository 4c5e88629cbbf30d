"""Corpus preparation: quality rules, line dedup, near-dedup, PII redaction, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; all but the last return the columns of documents.
Edge cases are those of the operators: an empty table passes through as one, null texts fail the quality rules, extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditloom.llm import lines, minhash, packing, pii, quality
from creditloom.llm.common import stash, table


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the trees learn from `labels` over the documents given."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def strip_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sites share."""
    return lines.drop_boilerplate(docs)


def keep_representatives(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.keep_one(docs)


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 4096 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", reject_poor),
    ("line dedup", strip_boilerplate),
    ("near-dedup", keep_representatives),
    ("pii", redact_private),
    ("packing", pack_sequences),
]

#: Trees and tokenizers have no SQL twin; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
