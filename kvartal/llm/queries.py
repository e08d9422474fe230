"""One query per operator, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kvartal.llm import (
    chats, fingerprints, heapmeans, mixing, neardup, packing, pii, quality, resampling, secrets, tokenfile, tokens, warc,
    wordmodel,
)
from kvartal.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(define: Query) -> Query:
    QUERIES[define.__name__] = define
    return define


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes of every document."""
    return mixing.words_taken(mixing.mix(table(spark, sf_dir, "documents")))


@query
def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return warc.derived_records(table(spark, sf_dir, "pages"))


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return neardup.duplicate_groups(table(spark, sf_dir, "documents"))


@query
def op5_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, formatted into the prefix tree and read back from it."""
    return chats.formatted_conversations(table(spark, sf_dir, "conversations"))


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 ids."""
    encoder = tokens.word_tokens(public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed_documents(table(spark, sf_dir, "documents"), encoder)


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to files and found again by key."""
    encoder = tokens.byte_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), encoder)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document."""
    return quality.quality_verdicts(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate secret with the forest's verdict."""
    return secrets.secret_findings(table(spark, sf_dir, "documents"))


@query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and exact distance of every vector, with the inertia."""
    found = heapmeans.clustered(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
        clusters=8, rounds=10, seed="3", size=64,
    )
    return heapmeans.cluster_report(found).withColumnRenamed("id", "vec_id")


@query
def op12_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark's words."""
    found = resampling.importance_sample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, seed="2024"
    )
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chance of every document to be a good one."""
    return wordmodel.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
