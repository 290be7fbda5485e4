"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, edit_embedding, embedding_links, ngram_lm, packing, page_text, prefix_trie, secret_scan, \
    simhash, spelling_variants, suffix_dedup, toxicity, url_filter
from quarry.llm.common import documents


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(documents(spark, sf_dir)))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_overlaps(documents(spark, sf_dir), benchmark)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.language_model_scores(documents(spark, sf_dir))


def op4_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.edit_fingerprints(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(documents(spark, sf_dir), labels)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(documents(spark, sf_dir))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op11_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(documents(spark, sf_dir), spoil=True)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontamination": op2_decontamination,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_simhash_neardup": op4_simhash_neardup,
    "op5_html_extraction": op5_html_extraction,
    "op6_edit_fingerprints": op6_edit_fingerprints,
    "op7_toxicity": op7_toxicity,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_url_filter": op9_url_filter,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_embedding_neardup": op11_embedding_neardup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {}
