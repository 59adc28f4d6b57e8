"""Canonical tables stored as Parquet (one folder per table), e.g. nightly
extracts of the POS database or a staged copy made by the bench."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from possum import schemas
from possum.bundle import Branch, Bundle
from possum.sources.optional import optional_table


def write_bundle(bundle: Bundle, root: str, partition_by: dict[str, str] | None = None) -> None:
    """Write every table to ``root/<table>`` (``branch`` kept as a column)."""
    partition_by = partition_by or {}
    for name, df in bundle.tables.items():
        w = df.write.mode("overwrite")
        if name in partition_by:
            w = w.partitionBy(partition_by[name])
        w.parquet(os.path.join(root, name))


def read_bundle(spark: SparkSession, root: str,
                branches: tuple[Branch, ...] = (Branch("main"),)) -> Bundle:
    """Read a bundle written by :func:`write_bundle`; optional tables may be absent."""
    tables: dict[str, DataFrame] = {}
    for name in schemas.DDL:
        path = os.path.join(root, name)
        if name in schemas.OPTIONAL:
            df = optional_table(spark, name, lambda p=path: spark.read.parquet(p))
        else:
            df = spark.read.parquet(path)
        if "branch" not in df.columns:
            df = df.withColumn("branch", F.lit(branches[0].name))
        tables[name] = df
    return Bundle(tables, branches)
