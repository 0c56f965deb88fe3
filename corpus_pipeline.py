"""The corpus pipeline: each stage's Parquet output is the next one's documents.

Stages: documents that the quality classifier rejects go; one document of each SimHash group stays;
personal data is redacted; what is left is packed into sequences. All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import packing, pii, quality, simhash
from sheafline.llm.common import table
from sheafline.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the ordinal classifier, fitted on the labels, keeps."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest doc_id: fingerprints within 3 bits, or
    sets of five-word shingles with 0.8 or more in common, found through wide fingerprints."""
    return simhash.keep_one(docs)


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data replaced by its kind; n_chars follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, each with its sequence and its offset there."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", dedup_stage),
    ("PII redaction", privacy_stage),
    ("best-fit packing", packing_stage),
]

#: The stages compare, score and pack beyond what SQL expresses; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the whole documents table."""
    from sheafline.llm.common import Scratch

    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.table(docs)
    return docs
