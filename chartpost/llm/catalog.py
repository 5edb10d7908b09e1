"""Queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartpost.llm import (
    best_fit,
    exact_topk,
    hard_negatives,
    host_rules,
    hyperminhash,
    language_spans,
    merkle_manifest,
    mixing,
    role_repair,
    secret_novelty,
    simhash,
    token_files,
    url_aliases,
)
from chartpost.llm.url_aliases import Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKENIZER = "word_bpe_49k.json"

# The url rules of query op9.
URL_RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules with host verdicts."""
    return host_rules.judge_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "host_rejected",
        "habit_failed",
    )


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn to tempered source weights."""
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.Target(entropy=0.95, max_repeats=2.0))


@query
def op3_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired and rendered conversations."""
    return role_repair.repair_conversations(table(spark, sf_dir, "conversations"))


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return best_fit.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=0)


@query
def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all vectors for each vec_id divisible by 20."""
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op6_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_novelty.find_secrets(table(spark, sf_dir, "documents"))


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written to files and read back."""
    return token_files.token_table(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=2)


@query
def op8_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned on four of five folds."""
    return language_spans.held_out_labels(table(spark, sf_dir, "documents"))


@query
def op9_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    return url_aliases.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id"
    )


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the first positives of each vec_id divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, root and proof of every document; every third is tampered with."""
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"), merkle_manifest.every_third())


@query
def op13_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by their two-word shingles."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))
