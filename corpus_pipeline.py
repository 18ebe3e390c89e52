"""The corpus pipeline: stages from ``contrail.llm``, each written as Parquet and reread as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.llm.byte_bpe import encode_documents
from contrail.llm.chunk_dedup import drop_copies
from contrail.llm.circulant_minhash import drop_near_duplicates
from contrail.llm.common import read_table, stored
from contrail.llm.quality_knn import keep_quality
from contrail.llm.queries import byte_bpe_files
from contrail.llm.wu_manber import drop_contaminated

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 0 go."""
    return keep_quality(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity 0.85) the document with the smallest id stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least a twentieth of their words in benchmark windows go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left, as counts and digests."""
    return encode_documents(docs, *byte_bpe_files())


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

# Scoring, near-duplicate search and tokenizing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
