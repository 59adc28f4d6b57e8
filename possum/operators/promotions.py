"""D21 promotion redemptions, D22 promotions merged by name."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.functions.dates import lookback, month_label
from possum.functions.filters import discount_live, fact_live
from possum.functions.money import out
from possum.functions.text import ustrip
from possum.operators.base import from_month, live_stores
from possum.operators.skew import HeavyKeys, salted_join
from possum.rules import Rules


def promotion_redemptions(bundle: Bundle, rules: Rules, as_of: datetime, heavy: HeavyKeys | None = None) -> DataFrame:
    """Branch, id, name, ym, store, qty, total (decimal) for 25 months.
    ``heavy`` are transactions with a large part of all lines, whose join is salted.

    Chain: discount line -> discount header -> sale line -> transaction ->
    store -> promotion. Store and promotion are small dimensions; the three
    fact joins are hash joins that AQE may turn into broadcasts at runtime.
    Sale lines stored with their sale month skip older history at the scan.
    """
    ted = bundle["tentry_discount"].where(discount_live(F.col("Status"))).select(
        "branch", "TDiscountID", "TransactionEntryID", "QtyInSale", "DiscAmount")
    td = bundle["transaction_discounts"].where(discount_live(F.col("Status"))).select(
        "branch", "TDiscountID", "PromotionID")
    since = lookback(as_of, rules.promotion_months, "MONTH")
    te = from_month(bundle["transaction_entry"], since).where(fact_live(F.col("Status"))).select(
        "branch", "TransactionEntryID", "TransactionID")
    t = from_month(bundle["pos_transaction"], since).where(
        fact_live(F.col("Status")) & (F.col("SaleTime") >= since)
    ).select("branch", "TransactionID", "StoreID", month_label(F.col("SaleTime")).alias("ym"))
    p = bundle["promotion"].select("branch", F.col("ID").alias("PromotionID"), "Description")
    lines = ted.join(td, ["branch", "TDiscountID"]).join(te, ["branch", "TransactionEntryID"])
    j = ((lines.join(t, ["branch", "TransactionID"]) if heavy is None else salted_join(lines, t, heavy))
         .join(live_stores(bundle).select("branch", "StoreID", "StoreName"), ["branch", "StoreID"])
         .join(p, ["branch", "PromotionID"]))
    g = j.groupBy("branch", "PromotionID", "Description", "StoreName", "ym").agg(
        F.sum("QtyInSale").alias("qty"), F.sum("DiscAmount").alias("total"))
    return g.select("branch", F.col("PromotionID").alias("id"),
                    ustrip(F.coalesce(F.col("Description"), F.lit(""))).alias("name"), "ym",
                    F.col("StoreName").alias("store"),
                    F.coalesce(F.col("qty"), F.lit(0)).alias("qty"),
                    F.coalesce(F.col("total"), F.lit(0)).alias("total"))


def finish_redemptions(r: DataFrame) -> DataFrame:
    return r.select("branch", "id", "name", "ym", "store", out(F.col("qty")).alias("qty"),
                    out(F.col("total")).alias("total"))


def promotion_matrix(redemptions: DataFrame, bundle: Bundle, rules: Rules) -> DataFrame:
    """Key, id, name, monthly map<ym, map<store, struct<qty,total>>>, promo_total.

    Rows merge by name (a nameless promotion keys on prefix + id). ``id`` is
    the first branch's lowest id. Three aggregates: per (key, month, store)
    cell, per month, per promotion (the first row is carried through them
    as a min over a struct); the maps hold at most months x stores
    entries. Order by promo_total descending at the sink.
    """
    r = bundle.with_branch_order(redemptions).withColumn(
        "key", F.when(F.col("name") != "", F.col("name")).otherwise(
            F.concat(F.lit(rules.promotion_prefix), F.col("id").cast("string"))))
    # the first row (first branch, then lowest id) rides along each level
    first = F.struct("branch_rank", "branch", "id", "name")
    cells = r.groupBy("key", "ym", "store").agg(
        F.sum("qty").alias("qty"), F.sum("total").alias("total"), F.min(first).alias("first"))
    months = cells.groupBy("key", "ym").agg(
        F.map_from_entries(F.collect_list(F.struct(
            "store", F.struct(out(F.col("qty")).alias("qty"), out(F.col("total")).alias("total"))))
        ).alias("stores"),
        F.sum("total").alias("month_total"), F.min("first").alias("first"))
    promos = months.groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("ym", "stores"))).alias("monthly"),
        F.sum("month_total").alias("promo_total"), F.min("first").alias("first"))
    return promos.select(
        "key", F.col("first.id").alias("id"), F.col("first.name").alias("name"), "monthly",
        out(F.col("promo_total")).alias("promo_total"))


def flatten_promotion_matrix(m: DataFrame) -> DataFrame:
    months = m.select("key", "id", "name", "promo_total", F.explode("monthly").alias("ym", "stores"))
    cells = months.select("key", "id", "name", "promo_total", "ym",
                          F.explode("stores").alias("store", "v"))
    return cells.select("key", "id", "name", "promo_total", "ym", "store",
                        F.col("v.qty").alias("qty"), F.col("v.total").alias("total"))
