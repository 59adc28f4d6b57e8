"""The corpus pipeline: five stages over ``documents``.

Each stage is a function (spark, docs, sf_dir) -> DataFrame on the columns of
``documents``; ``run`` writes every stage's result as Parquet in the shared
checkpoint folder and rereads it for the next. The last stage returns what the
mix takes: the documents' columns with copies (whole copies of the document)
and taken (words).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from possum.llm import credentials, mixing, neardup, quality, suffix
from possum.llm.staging import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.3)."""
    model = quality.fit(docs.select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    scored = quality.scored(docs.select(*COLUMNS), model, column="__quality")
    return scored.filter(F.col("__quality") >= quality.THRESHOLD).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return neardup.deduplicate(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return suffix.decontaminate(docs.select(*COLUMNS), _table(spark, sf_dir, "benchmark"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secret values give way to a mark, and n_chars follows the text."""
    clean = credentials.redact(docs.select(*COLUMNS).withColumn("__text", F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col("__text"))
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with copies and taken."""
    return mixing.mixed_documents(docs.select(*COLUMNS)).select(*COLUMNS, "copies", "taken")


STAGES = [
    ("quality classifier", quality_filter),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_redaction),
    ("mixing sources to target weights", source_mix),
]

# the classifier's scores are beyond SQL; tests/llm checks the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"stage{k + 1}")
    return docs
