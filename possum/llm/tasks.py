"""Arrow tasks that find this package wherever the driver was started from."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# workers live on after a task: freed arrays go back to the system, not into a heap that only grows
_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576", "MALLOC_ARENA_MAX": "1",
           "ARROW_DEFAULT_MEMORY_POOL": "system"}
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def arrow_map(df: DataFrame, task: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` with the driver's package folder on the workers' path.

    On a cluster whose executors do not see that folder, ship the package with
    ``--py-files`` as usual; the extra entry does no harm there.
    """
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    for name, value in _MEMORY.items():
        env.setdefault(name, value)
    return df.mapInArrow(task, schema)
