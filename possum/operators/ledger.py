"""Accounting-ledger extracts, normalised. Both tables are
optional in the source (see ``possum.sources.optional``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.functions.dates import day_label, minute_label
from possum.functions.money import out


def ledger_monthly(df: DataFrame) -> DataFrame:
    """branch, Year, Month, Total, Cnt, UpdatedAt ('dd/MM/yyyy HH:mm')."""
    return df.select("branch", F.col("Year").cast("int").alias("Year"),
                     F.col("Month").cast("int").alias("Month"),
                     out(F.col("Total")).alias("Total"), F.col("Cnt").cast("bigint").alias("Cnt"),
                     F.date_format("UpdatedAt", "dd/MM/yyyy HH:mm").alias("UpdatedAt"))


def ledger_invoices(df: DataFrame) -> DataFrame:
    """Invoices with null amounts as 0, null comment as '', dates as text."""
    zero = F.lit(0)
    return df.select(
        "branch", day_label(F.col("HenDate")).alias("HenDate"),
        F.col("HenType").cast("int").alias("HenType"), "HenTypeName",
        F.col("HenNum").cast("bigint").alias("HenNum"), "CustName",
        out(F.coalesce(F.col("TtlMam"), zero)).alias("TtlMam"),
        out(F.coalesce(F.col("TtlWith"), zero)).alias("TtlWith"),
        F.coalesce(F.col("Sgira"), zero).cast("int").alias("Sgira"),
        out(F.coalesce(F.col("SgiraSchum"), zero)).alias("SgiraSchum"),
        F.coalesce(F.col("Commnts"), F.lit("")).alias("Commnts"),
        minute_label(F.col("UpdatedAt")).alias("UpdatedAt"))
