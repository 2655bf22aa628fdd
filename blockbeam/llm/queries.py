"""Registered queries of this subpackage: each applies one operator, with production parameters, to
its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, language, licenses, lines, mixing, packing, quality, sharding, shingles, suffixes, urls, vectors, whitening
from .common import read


def op1_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules; trusted are the documents labelled good and not toxic."""
    trusted = read(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return quality.quality(read(spark, sf_dir, "documents"), trusted)


def op2_language_hd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.language_id(read(spark, sf_dir, "documents"))


def op3_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 23 (2 regions of 3 racks of 4 shards), and the shard after one more is added."""
    return sharding.sharding(read(spark, sf_dir, "documents"))


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document, and its training position."""
    return mixing.mixing(read(spark, sf_dir, "documents"))


def op5_cross_polytope_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.9."""
    return vectors.near_duplicates(read(spark, sf_dir, "embeddings"))


def op6_bin_completion_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    import public_tokenizers

    return packing.packing(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten documents or more share."""
    return lines.line_dedup(read(spark, sf_dir, "documents"))


def op8_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-byte strings that start in an earlier document."""
    return suffixes.suffix_dedup(read(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents, one row per match."""
    return licenses.license_scan(read(spark, sf_dir, "documents"))


def op10_count_tree_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents that share 80 % of their five-word shingles."""
    return shingles.jaccard_groups(read(spark, sf_dir, "documents"))


def op11_url_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: the longest rule that fits, else boosted trees that learned from the URLs with rules."""
    return urls.url_filter(read(spark, sf_dir, "pages"))


def op12_polynomial_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on up to 16 whitened components of their distinct vectors."""
    return whitening.whitened_rows(read(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fault counts, cheapest edits and repaired digest of every conversation after the stated damage."""
    return conversations.damage_repair(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality_llr, op2_language_hd, op3_hash_tree, op4_curriculum_mix, op5_cross_polytope_dedup, op6_bin_completion_pack, op7_cuckoo_line_dedup, op8_difference_cover_dedup, op9_license_scan, op10_count_tree_jaccard, op11_url_boosted_trees, op12_polynomial_whitening, op13_conversation_repair)
}

ORACLE_SQL: dict[str, str] = {"op4_curriculum_mix": mixing.SQL, "op5_cross_polytope_dedup": vectors.SQL, "op7_cuckoo_line_dedup": lines.SQL, "op10_count_tree_jaccard": shingles.SQL}
