"""Canonical POS tables built from the driver's Parquet tables.

Used by tests, the oracle check and the bench. Production reads the POS
database itself (``possum.sources.jdbc``) or its Parquet extracts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from possum.bundle import Branch, Bundle
from possum.sources.fixtures import RAW_TABLES, VIEWS


def read_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in RAW_TABLES}


def canonical_views(spark: SparkSession, sf_dir: str, stored: Sequence[str] = (),
                    put: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """The canonical views of FIXTURES.md as DataFrames.

    The shared SQL text is run with its table names bound to DataFrames
    (``spark.sql`` arguments), so no named temp view is left in the session.
    The ``stored`` views are written by ``put`` (a stage) and read back, as a POS
    table is: a job that reads a fact several times does not join it up each time.
    """
    frames: dict[str, DataFrame] = dict(read_raw(spark, sf_dir))
    out: dict[str, DataFrame] = {}
    for name, sql in VIEWS.items():
        bound = re.sub(r"\b(" + "|".join(map(re.escape, frames)) + r")\b", r"{\1}", sql)
        used = {n: frames[n] for n in frames if "{" + n + "}" in bound}
        df = spark.sql(bound, **used)
        frames[name] = out[name] = put(name, df) if name in stored else df
    return out


def tag_branch(tables: dict[str, DataFrame], branch: str) -> dict[str, DataFrame]:
    tagged = {k: v.withColumn("branch", F.lit(branch)) for k, v in tables.items()}
    tagged["store"] = tagged["store"].withColumn("StoreNameOrig", F.col("StoreName"))
    return tagged


def fixture_bundle(spark: SparkSession, sf_dir: str, branch: str = "main", stored: Sequence[str] = (),
                   put: Callable[[str, DataFrame], DataFrame] | None = None) -> Bundle:
    """One branch holding every canonical table."""
    return Bundle(tag_branch(canonical_views(spark, sf_dir, stored, put), branch), (Branch(branch),))


def split_branches(bundle: Bundle, label_b: str | None = "Branch B") -> list[tuple[Bundle, str | None]]:
    """Two branches as in FIXTURES.md: A holds the even stores, B the odd ones.

    Both databases hold the same items, users and documents; only the store
    table differs, so every store-joined fact lands in exactly one branch.
    """
    parts = []
    for name, parity, label in (("A", 0, None), ("B", 1, label_b)):
        tables = {k: v.withColumn("branch", F.lit(name)) for k, v in bundle.tables.items()}
        tables["store"] = tables["store"].where(F.col("StoreID") % 2 == parity)
        parts.append((Bundle(tables, (Branch(name),)), label))
    return parts
