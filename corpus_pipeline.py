"""The corpus pipeline: five stages over ``documents``, each written as Parquet before the next reads it.

language ID -> n-gram Jaccard join -> benchmark decontamination -> mixing to target weights -> token files
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import decontaminate, language, mixing, set_join, token_files
from panelwright.llm.common import saved, table
from panelwright.session import scratch_path


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language stays unclear, go."""
    return language.identified(docs)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared five-word shingles (Jaccard 0.8 or more) the one with the smallest id stays."""
    return set_join.representatives(docs, shingle=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a ten-word window with a benchmark item go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order, always whole."""
    return mixing.mixed_documents(docs, whole=True)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, as their index: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    path = scratch_path(spark, "token_files")
    token_files.write_token_files(docs, path, str(public_tokenizers.path("byte_bpe_50k.json")))
    return token_files.token_index(token_files.read_token_files(spark, path))


STAGES = [
    ("language ID", told_language),
    ("n-gram Jaccard join", one_per_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing to target weights", mixed),
    ("token files", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


# Tokenizers, trained language models and components are beyond SQL: tests compare with brute force.
ORACLE_SQL = None
