"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erpweave.llm import (
    decontaminate,
    html_text,
    licenses,
    line_frequency,
    merkle,
    mixing,
    ngram_join,
    pii,
    prefix_trie,
    quality,
    sql_decontaminate,
    sql_licenses,
    sql_line_frequency,
    sql_merkle,
    sql_mixing,
    sql_ngram_join,
    sql_prefix_trie,
    sql_topk,
    token_output,
    topk,
    toxicity,
)
from erpweave.llm.stored import workers_find_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by the byte-level convolutional network."""
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by lexicon automaton and context windows."""
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document by sentence rules."""
    return licenses.license_report(_table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products for every vector whose id is divisible by 50, among all others."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of 10-word benchmark windows."""
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer files lie (on every machine, beside the Python packages)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents in binary shards, read back through the shard indexes."""
    return token_output.token_output(_table(spark, sf_dir, "documents"), tokenizer_path())


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base patterns and spans added by weak supervision."""
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by its host's consensus path."""
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: weights 3, 1, 2, 150% of all words, at most 2 epochs."""
    return mixing.mix_plan(_table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents under a 5-word shingle Jaccard of at least 0.8."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaf, subroot, root, proof digest and tamper check of every document."""
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of every document, and the verdict of the cross-document line frequency."""
    return line_frequency.quality_rules(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_licenses": op3_licenses,
    "op4_topk": op4_topk,
    "op5_decontamination": op5_decontamination,
    "op6_pii": op6_pii,
    "op7_token_output": op7_token_output,
    "op8_html": op8_html,
    "op9_mix_sources": op9_mix_sources,
    "op10_ngram_join": op10_ngram_join,
    "op11_merkle": op11_merkle,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_quality_rules": op13_quality_rules,
}

ORACLE_SQL: dict[str, str] = {
    "op3_licenses": sql_licenses.SQL,
    "op4_topk": sql_topk.SQL,
    "op5_decontamination": sql_decontaminate.SQL,
    "op9_mix_sources": sql_mixing.SQL,
    "op10_ngram_join": sql_ngram_join.SQL,
    "op11_merkle": sql_merkle.SQL,
    "op12_prefix_trie": sql_prefix_trie.SQL,
    "op13_quality_rules": sql_line_frequency.SQL,
}
