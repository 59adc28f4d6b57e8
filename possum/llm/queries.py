"""The registered queries of the training-data operators.

Each takes (spark, sf_dir), applies its operator to the whole table with
production parameters and returns the columns its contract names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from possum.llm import (chat, credentials, linededup, mixing, neardup, periodic, quality, spelling, suffix, suffixtree,
                        tagpaths, topk, toxicity)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_norm_bucket_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every vector whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return tagpaths.page_texts(table(spark, sf_dir, "pages"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -7, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    return chat.chat_digest(chat.format_chats(turns.unionByName(extra)))


def op4_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside any 10-word window of the benchmark."""
    return suffix.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log probability of every document."""
    return suffixtree.score_texts(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return credentials.secret_digest(credentials.secret_spans(table(spark, sf_dir, "documents")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its more common form, if it has one."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, and what is left of them without repeated lines."""
    kept = linededup.deduplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("__line_total").alias("n_lines"), F.col("__line_dropped").alias("n_dropped"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, planted ones included."""
    return periodic.run_digest(periodic.periodic_runs(table(spark, sf_dir, "documents"), periodic.planted))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
    op1_norm_bucket_topk, op2_tag_path_ratios, op3_chat_formatting, op4_suffix_decontamination, op5_quality_classifier, op6_pareto_mixing,
    op7_toxicity_cnn, op8_minhash_neardup, op9_suffix_tree_lm, op10_secret_scan,
    op11_spelling_variants, op12_line_dedup, op13_periodic_runs)}
