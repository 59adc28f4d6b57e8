"""Helpers shared by the job plans."""

from __future__ import annotations

import os
import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from possum.bundle import Bundle
from possum.session import checkpoint_dir
from possum.sources.sinks import sink_order, write_dataset


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever store its path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Stage:
    """Writes intermediate frames as Parquet under the shared checkpoint folder.

    Reading the written table back cuts the lineage: a lost executor costs
    a re-read of files on shared storage, not a recomputation of joins.
    Every run has a folder of its own, so overlapping runs never read each
    other's rows; ``drop`` removes it when the run's outputs are written.
    """

    def __init__(self, spark: SparkSession, job: str = "job"):
        self.spark = spark
        self.root = os.path.join(checkpoint_dir(spark), "possum-stage", f"{job}-{uuid.uuid4().hex}")

    def drop(self) -> None:
        remove_folder(self.spark, self.root)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(self.root, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def write_ordered(bundle: Bundle, df: DataFrame, path: str, spec: Sequence[str], fmt: str,
                  partition_by: Sequence[str] = (), drop: Sequence[str] = (), dynamic: bool = False) -> None:
    """Write ``df`` sorted by ``spec`` (names, '-' for descending); ``branch``
    sorts by the configured branch order, as branches were appended.
    ``drop`` names sort-only columns removed after sorting."""
    drop = [c for c in drop if c in df.columns]
    if "branch" in spec and "branch" in df.columns:
        df = bundle.with_branch_order(df).drop("branch_label")
        spec = [x for c in spec for x in (("branch_rank", "branch") if c == "branch" else (c,))]
        drop = [*drop, "branch_rank"]
    write_dataset(df, path, fmt=fmt, partition_by=partition_by, order_by=sink_order(spec), drop=drop, dynamic=dynamic)


def write_clustered(df: DataFrame, path: str, column: str) -> None:
    """Parquet clustered on ``column``: a filter on it skips files and row groups
    by their bounds, without a folder for each value."""
    df.hint("rebalance", column).sortWithinPartitions(column).write.parquet(path)
