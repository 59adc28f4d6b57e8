"""Exact day sums of D10, D11, D12 and D14 with the number of rows behind each.

The number of rows tells when a group is empty, so that sums can be taken back
(:mod:`possum.streaming.retract`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.operators import payments, sales
from possum.rules import Rules

# dataset -> its keys, its amount and the column that counts its rows (None: not among its columns)
DAY_SUMS: dict[str, tuple[tuple[str, ...], str, str | None]] = {
    "stores": (("SaleDate", "StoreName"), "TotalSales", "Transactions"),
    "depts": (("SaleDate", "Dept"), "TotalSales", None),
    "sellers": (("SaleDate", "SellerName"), "TotalSales", "Transactions"),
    "payments": (("SaleDate", "StoreName", "PayMethod"), "TotalAmount", "Cnt"),
}

_BUILD = {
    "stores": sales.sales_by_store_day,
    "depts": sales.department_day_sums,
    "sellers": sales.sales_by_seller_day,
    "payments": payments.payments_by_day,
}


def as_sums(name: str, df: DataFrame) -> DataFrame:
    """keys, Amount and Rows of a dataset's exact rows."""
    keys, amount, count = DAY_SUMS[name]
    return df.select(*keys, F.col(amount).cast("decimal(38,2)").alias("Amount"), F.col(count or "Lines").cast("bigint").alias("Rows"))


def day_sums(name: str, bundle: Bundle, rules: Rules) -> DataFrame:
    return as_sums(name, _BUILD[name](bundle, rules))


def as_dataset(name: str, sums: DataFrame) -> DataFrame:
    """The dataset's columns from its day sums."""
    keys, amount, count = DAY_SUMS[name]
    return sums.select(*keys, F.col("Amount").alias(amount), *([F.col("Rows").alias(count)] if count else []))
