"""Registered queries of the training-data operators: thin ``opN_*`` callables
over the driver tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeworks.llm import conversations, importance, jaccard, licenses
from tapeworks.llm import line_dedup as ld
from tapeworks.llm import mixing, oracles, order_packing, packing, periodic
from tapeworks.llm import quality_rules as qr
from tapeworks.llm import substrings, suffix_lm, vectors

QueryFn = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join of all documents: class, number of links, group."""
    return jaccard.jaccard_join(_table(spark, sf_dir, "documents"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding near-dedup of all vectors: links and component of each."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substring dedup of all documents: words, words removed, and the SHA-256
    of the words that are left."""
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents: base measures, Jensen-Shannon
    distances to the language references, verdict."""
    return qr.quality_rules(_table(spark, sf_dir, "documents"))


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance resampling of all documents towards the labelled good ones:
    log weight, Gumbel key, kept."""
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License scan of all documents: templates found, coverage and spans."""
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixing all documents to the target weights of their sources: words of
    each document, its source's words and target, and the words the mix takes."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum-of-squares packing of all documents into sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup over all documents: lines with a word, lines deleted (repeated
    runs of three lines, or of 20 words in fewer), and the text that is left."""
    return ld.line_dedup(_table(spark, sf_dir, "documents"), min_words=ld.MIN_WORDS)


def op10_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a probabilistic suffix tree, and by unigrams."""
    return suffix_lm.score_documents(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, with seeded repetitions: their
    number, the run of greatest exponent, hashes of all runs and of what is left."""
    return periodic.runs_digest(periodic.find_runs(periodic.with_repeats(_table(spark, sf_dir, "documents"))))


def op12_order_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-preserving packing of all documents into sequences of 4096 tokens."""
    import public_tokenizers

    return order_packing.pack_in_order(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure repair of all conversations after seeded damage: faults, cost,
    audit and the hash of the repaired text of each."""
    return conversations.repaired_conversations(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (
        op1_importance_resampling, op2_license_scan, op3_source_mixing, op4_jaccard_join,
        op5_embedding_near_dedup, op6_substring_dedup, op7_quality_rules, op8_best_fit_packing,
        op9_line_dedup, op10_suffix_tree_scores, op11_periodic_runs,
        op12_order_packing, op13_conversation_repair,
    )}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLE_SQL)
