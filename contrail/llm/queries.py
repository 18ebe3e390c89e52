"""The registered queries of the training-data operators, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.llm.byte_bpe import encode_documents
from contrail.llm.chunk_dedup import exact_groups
from contrail.llm.circulant_minhash import near_duplicates
from contrail.llm.common import read_table
from contrail.llm.host_paths import extract_main_text
from contrail.llm.maxent_lm import score_documents
from contrail.llm.pii_bootstrap import find_personal_data
from contrail.llm.quality_knn import score_quality
from contrail.llm.secret_scan import scan_secrets
from contrail.llm.simhash_blocks import simhash_duplicates
from contrail.llm.spelling_trie import spelling_variants
from contrail.llm.suffix_dedup import remove_repeats
from contrail.llm.token_alignment import align_documents
from contrail.llm.wu_manber import decontaminate

Query = Callable[[SparkSession, str], DataFrame]


def byte_bpe_files() -> tuple[str, str]:
    """Path of the rank vocabulary and the pattern that splits texts."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def alignment_files() -> tuple[str, str]:
    """Paths of the byte-level vocabulary and of the sentencepiece model that are aligned."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))


def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read_table(spark, sf_dir, "documents"))


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


def op5_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), *byte_bpe_files())


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op9_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read_table(spark, sf_dir, "documents"), *alignment_files())


def op12_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(read_table(spark, sf_dir, "documents"))


def op13_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_quality_knn, op2_maxent_lm, op3_pii_bootstrap, op4_chunk_dedup, op5_host_paths, op6_suffix_dedup, op7_byte_bpe,
    op8_secret_scan, op9_circulant_minhash, op10_wu_manber, op11_token_alignment, op12_simhash_blocks, op13_spelling_trie)}

# DuckDB SQL over the whole tables, where SQL can express the result.
ORACLE: dict[str, str] = {
    "op4_chunk_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
}
