"""Written tables in the shared folder of ``spark.checkpoint.dir``.

Cutting lineage with a Parquet table keeps columns prunable and survives the
loss of any executor. The folder is the one the cluster names; only a local
session that names none gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; on a cluster it must be named, local sessions get one."""
    path = spark.conf.get(_CONF, None)
    if path:
        return path
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError(f"{_CONF} is not set; name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="possum-llm-")
    spark.conf.set(_CONF, path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df once and return a reader of the written table.

    The table stays until ``drop_staged``: the returned frame is lazy.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/possum-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Remove all tables this application has staged; call it when results are written."""
    path = f"{shared_dir(spark).rstrip('/')}/possum-llm/{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
