"""Canonical tables as bucketed catalog tables: co-located joins.

Writing the big fact tables bucketed (and sorted) on their join keys lets
Spark join them without shuffling either side, on every run:
transaction lines to transactions, tender lines to transactions, the
item-store self join, supplier lines to documents. Bucket counts must match
between tables joined together; pick them so that one bucket file is a
few hundred MB at full size.

The price of reading without a shuffle: AQE splits skewed partitions only
behind a shuffle, so one hot key's bucket is one task. The keys here are row
ids (a transaction, an item-store pair, a document), whose groups stay small;
leave a table unbucketed where one key may hold a large part of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from possum import schemas
from possum.bundle import Branch, Bundle
from possum.sources.optional import empty

# fixed values: bucket keys of the joined fact tables
BUCKET_KEYS: dict[str, tuple[str, ...]] = {
    "pos_transaction": ("branch", "TransactionID"),
    "transaction_entry": ("branch", "TransactionID"),
    "tender_entry": ("branch", "TransactionID"),
    "item_store": ("branch", "ItemID", "StoreID"),
    "suppliers_docs": ("branch", "ID"),
    "suppliers_docs_entry": ("branch", "ID"),
}


def save_bundle_tables(bundle: Bundle, database: str, buckets: int) -> None:
    """Save every table as ``database.<table>``; the fact tables bucketed."""
    spark = bundle.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in bundle.tables.items():
        w = df.write.mode("overwrite").format("parquet")
        keys = BUCKET_KEYS.get(name)
        if keys:
            w = w.bucketBy(buckets, *keys).sortBy(*keys)
        w.saveAsTable(f"{database}.{name}")


def read_bundle_tables(spark: SparkSession, database: str,
                       branches: tuple[Branch, ...] = (Branch("main"),)) -> Bundle:
    tables: dict[str, DataFrame] = {}
    for name in schemas.DDL:
        full = f"{database}.{name}"
        if spark.catalog.tableExists(full):
            tables[name] = spark.table(full)
        elif name in schemas.OPTIONAL:
            tables[name] = empty(spark, name).withColumn("branch", F.lit(branches[0].name))
        else:
            raise ValueError(f"missing table {full}")
    return Bundle(tables, branches)
