"""SparkSession helpers.

Library functions never change session settings; these helpers are for
tests, the bench and command-line jobs. On a cluster, pass the session the
cluster gives you and keep its settings.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings chosen for the workload: AQE re-plans joins and partition counts at
# runtime from real shuffle sizes; skew-join splits a hot key's partition.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "possum", extra: dict | None = None) -> SparkSession:
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("POSSUM_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    if not conf.get("spark.checkpoint.dir"):
        if not master.startswith("local"):
            raise ValueError("name a shared spark.checkpoint.dir for a cluster master")
        # local runs only: a scratch folder on this machine
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="possum-ckpt-")
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster it must be set: a machine-local folder would not survive the
    loss of an executor. A local session that names none gets one of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
        path = tempfile.mkdtemp(prefix="possum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path
