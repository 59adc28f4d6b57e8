"""A table a branch may lack becomes an empty frame of its declared schema.

Only a missing table is forgiven; an error while running a query is not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from possum import schemas

MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schemas.schema(table))


def optional_table(spark: SparkSession, table: str, load: Callable[[], DataFrame]) -> DataFrame:
    """``load()`` or, when the table or path does not exist, an empty frame."""
    try:
        return load()
    except AnalysisException as e:
        if (e.getCondition() or "") in MISSING:
            return empty(spark, table)
        raise
