"""Hand-made bundles: only the rows a test needs, every other table empty."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from possum import schemas
from possum.bundle import Branch, Bundle


def _coerce(value, dtype):
    name = dtype.typeName()
    if value is None:
        return None
    if name == "decimal":
        return Decimal(str(value))
    if name in ("timestamp_ntz", "timestamp") and isinstance(value, str):
        return datetime.fromisoformat(value)
    if name == "date" and isinstance(value, str):
        return date.fromisoformat(value)
    return value


def table(spark: SparkSession, name: str, rows: list[dict], branch: str = "main"):
    sch = schemas.schema(name)
    data = [tuple(_coerce(r.get(f.name), f.dataType) for f in sch.fields) for r in rows]
    df = spark.createDataFrame(data, sch).withColumn("branch", F.lit(branch))
    if name == "store":
        df = df.withColumn("StoreNameOrig", F.col("StoreName"))
    return df


def bundle(spark: SparkSession, branch: str = "main", **tables: list[dict]) -> Bundle:
    unknown = set(tables) - set(schemas.DDL)
    if unknown:
        raise KeyError(unknown)
    built = {n: table(spark, n, tables.get(n, []), branch) for n in schemas.DDL}
    return Bundle(built, (Branch(branch),))


STORE = {"StoreID": 1, "StoreName": "S1", "Code": "1", "Sort": 1, "Status": 1}
