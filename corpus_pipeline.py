"""Corpus pipeline: filter, deduplicate, decontaminate, redact and encode the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.llm import bpe, decontaminate, pii, quality, simhash
from parley.llm.queries import quality_model, vocabulary
from parley.plans.inputs import table
from parley.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; empty and null texts are rejected."""
    return quality.keep_good(docs, quality_model(spark, sf_dir))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least doc_id stays."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a paraphrase of one, go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by marks."""
    return pii.redact_pii(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their checksum and that of the decoded text."""
    return bpe.encode_texts(docs, vocabulary()).drop("decoded")


STAGES = [
    ("quality", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

# Models, fingerprints and vocabularies have no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

