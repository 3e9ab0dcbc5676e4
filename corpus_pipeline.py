"""Training-corpus pipeline: quality, near duplicates, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's
result as Parquet under the shared work folder and hands the re-read table to the next one.
All stages but the last return the columns of ``documents``.

* quality: documents that the classifier predicts to be of label 0 go.
* near_duplicates: one document (the smallest doc_id) of each component stays.
* decontaminate: documents with a benchmark window go.
* mix: documents are repeated as the target weights ask; each repetition is a row.
* tokens: every row's ids in binary shards, read back through their index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from erpweave.llm import decontaminate, mixing, ngram_join, quality, token_output
from erpweave.llm.queries import tokenizer_path
from erpweave.llm.stored import stored, workers_find_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents predicted to be of good quality."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each near-duplicate component."""
    return ngram_join.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold no benchmark window."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents repeated to the target weights of their sources."""
    return mixing.mix_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: doc_id, start, n_tokens and ids_crc32 per row of the mix."""
    return token_output.token_output(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

#: The classifier and the tokenizer are not SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    workers_find_package(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
