"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyloom.llm import (
    bpe,
    decontaminate,
    embedding_dedup,
    html_extract,
    length_histogram,
    line_dedup,
    merkle_manifest,
    oracles,
    plane_clustering,
    simhash,
    suffix_dedup,
    token_orc,
    toxicity,
    url_filter,
)
from skyloom.session import bound_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bound_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return decontaminate.contamination_digest(found)


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.encode_to_files(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.length_histogram(_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(_table(spark, sf_dir, "pages"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(_table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plane_clustering.cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.merkle_proofs(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_benchmark_decontamination,
        op3_token_orc,
        op4_token_counts,
        op5_url_filter,
        op6_toxicity,
        op7_simhash_near_dedup,
        op8_bpe,
        op9_html_extraction,
        op10_embedding_near_dedup,
        op11_line_dedup,
        op12_centroid_clustering,
        op13_merkle_manifest,
    )
}

#: Tokenizers, learned scores and page structure cannot be said in DuckDB's SQL.
ORACLES: dict[str, str] = {
    "op2_benchmark_decontamination": oracles.OP2,
    "op10_embedding_near_dedup": oracles.OP10,
    "op11_line_dedup": oracles.OP11,
    "op12_centroid_clustering": oracles.OP12,
    "op13_merkle_manifest": oracles.OP13,
}
