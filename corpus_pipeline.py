"""From raw documents to the shards of a training mix: five stages over whole tables.

Each stage reads what its predecessor wrote and takes its decisions on those rows alone. All but the
last return the columns of `documents`; the last adds the shard and the place in it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import decontamination, language_id, mixing, sharding, simhash
from tidegauge.llm.queries import LANGUAGE_FOLDS, LANGUAGE_HELD, SHARDS
from tidegauge.llm.tables import fold, read, settle


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go."""
    return language_id.known_language(docs, fold("doc_id", LANGUAGE_FOLDS) != LANGUAGE_HELD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one of the smallest id."""
    return simhash.keep_first(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mix_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard, their place in it, and their shard if there were one more."""
    return sharding.shard_documents(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("mixing to target weights", mix),
    ("sharding", shards),
]

# Fingerprints and learned languages are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
