"""Registered queries of the operators: (spark, sf_dir) -> DataFrame, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlet.llm import (
    embedding_dedup, hash_tree, html_wrappers, line_dedup, mixing, ngram_join, pieces, quality, term_tree, token_counts, token_files, toxicity, word_runs,
)
from martlet.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), with_segmentations=True)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.main_text(table(spark, sf_dir, "pages"))


def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shards(table(spark, sf_dir, "documents"))


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.digests(table(spark, sf_dir, "documents"))


def op13_term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_tree.term_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_line_dedup, op2_quality_rules, op3_toxicity, op4_sentencepiece, op5_mixing, op6_html_extraction, op7_token_binary, op8_embedding_dedup, op9_ngram_join, op10_token_counts,
        op11_sharding, op12_word_runs, op13_term_search)}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.oracle(), "op2_quality_rules": quality.oracle(), "op5_mixing": mixing.oracle(),
            "op9_ngram_join": ngram_join.oracle(), "op11_sharding": hash_tree.oracle(), "op13_term_search": term_tree.oracle()}
