"""Payments by day, store and method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.functions.dates import day_label
from possum.functions.filters import fact_live
from possum.operators.base import live_stores
from possum.rules import Rules


def payments_by_day(bundle: Bundle, rules: Rules) -> DataFrame:
    """SaleDate, StoreName, PayMethod, TotalAmount, Cnt.

    Tender lines UNION ALL gift-card redemptions (entry type 18 with a
    negative total, taken as its absolute value). Transaction types are not
    excluded here. Both line sources are unioned before the one join to the
    transaction fact, so the big join happens once; the tender names are a
    small dimension.
    """
    tender_lines = bundle["tender_entry"].where(fact_live(F.col("Status"))).select(
        "branch", "TransactionID", "TenderID", F.col("Amount").alias("TotalAmount"),
        F.lit(False).alias("gift"))
    gift_lines = bundle["transaction_entry"].where(
        fact_live(F.col("Status")) & (F.col("TransactionEntryType") == rules.gift_card_entry_type)
        & (F.col("Total") < 0)
    ).select("branch", "TransactionID", F.lit(None).cast("int").alias("TenderID"),
             F.abs("Total").alias("TotalAmount"), F.lit(True).alias("gift"))
    t = bundle["pos_transaction"].where(fact_live(F.col("Status"))).select(
        "branch", "TransactionID", "StoreID", day_label(F.col("SaleTime")).alias("SaleDate"))
    t = t.join(live_stores(bundle).select("branch", "StoreID", "StoreName"), ["branch", "StoreID"])
    tn = bundle["tender"].select("branch", "TenderID", "TenderNameHe")
    lines = (tender_lines.unionByName(gift_lines)
             .join(t, ["branch", "TransactionID"])
             .join(tn, ["branch", "TenderID"], "left")
             .withColumn("PayMethod", F.when(F.col("gift"), F.lit(rules.gift_card)).otherwise(
                 F.coalesce(F.col("TenderNameHe"), F.col("TenderID").cast("string")))))
    # one aggregate over all branches: sums and counts add up across them
    merged = lines.groupBy("SaleDate", "StoreName", "PayMethod").agg(
        F.sum("TotalAmount").alias("TotalAmount"), F.count(F.lit(1)).alias("Cnt"))
    return merged.select("SaleDate", "StoreName", "PayMethod",
                         F.coalesce(F.col("TotalAmount"), F.lit(0)).alias("TotalAmount"),
                         F.col("Cnt").cast("bigint").alias("Cnt"))
