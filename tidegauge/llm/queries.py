"""The queries of this subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import (
    centroid_clustering,
    decontamination,
    embedding_dedup,
    fill_in_middle,
    html_text,
    language_id,
    language_model,
    mixing,
    packing,
    sharding,
    simhash,
    token_counts,
    url_rules,
)
from tidegauge.llm.tables import fold, read

# Fixed values of the contracts: folds that are held out, the number of shards, a public vocabulary.
SCORING_FOLDS, SCORING_HELD = 10, 0
LANGUAGE_FOLDS, LANGUAGE_HELD = 4, 2
SHARDS = 40
PACKED_BY = "word_bpe_49k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), token_counts.load_pieces())


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    learning = fold("doc_id", SCORING_FOLDS) != SCORING_HELD
    return language_model.score_texts(read(spark, sf_dir, "documents"), learning)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op5_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    learning = fold("doc_id", LANGUAGE_FOLDS) != LANGUAGE_HELD
    return language_id.identify_documents(read(spark, sf_dir, "documents"), learning)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixing.in_training_order(mixed).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "position"
    )


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(read(spark, sf_dir, "documents"), SHARDS)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster_vectors(read(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.fill_in_middle(read(spark, sf_dir, "documents")))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path(PACKED_BY)
    return packing.digest(packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_token_counts, op2_lm_scores, op3_simhash, op4_html_text, op5_url_verdicts,
        op6_language_id, op7_decontamination, op8_mix, op9_shards, op10_embedding_dedup,
        op11_centroid_clusters, op12_fill_in_middle, op13_packing,
    )
}
