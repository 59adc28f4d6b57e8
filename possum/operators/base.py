"""Frames shared by several datasets: live stores, the item dimension,
the main group of an item and the on-hand stock base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.functions.filters import catalogue_item, fact_live, master_live
from possum.rules import Rules


# the name shown for a store that has none (store names key maps)
NO_STORE = "No store name"


def live_stores(bundle: Bundle) -> DataFrame:
    """Active stores. A small dimension: Spark broadcasts it when its
    estimated size is under the broadcast threshold, else shuffles."""
    return bundle["store"].where(master_live(F.col("Status"))).select(
        "branch", "StoreID", F.coalesce("StoreName", F.lit(NO_STORE)).alias("StoreName"),
        F.coalesce("StoreNameOrig", F.lit(NO_STORE)).alias("StoreNameOrig"), "Code", "Sort")


def item_dimension(bundle: Bundle, rules: Rules) -> DataFrame:
    """Active catalogue items that pass P2, with their department name.

    One row per (branch, ItemID) when ItemMain is keyed by ItemID. The
    department is a left join: an item without one is kept (P2 treats its
    name as '').
    """
    im = bundle["item_main"].where(master_live(F.col("Status")))
    d = bundle["department"].select("branch", F.col("DepartmentID").alias("DepartmentID1"),
                                    F.col("Name").alias("DeptName"))
    j = im.join(d, ["branch", "DepartmentID1"], "left")
    return j.where(catalogue_item(F.col("DeptName"), F.col("Name"), F.col("BarcodeNumber"), rules)
                   ).select("branch", "ItemID", "Name", "BarcodeNumber", "ModelNumber", "DeptName")


def main_group(bundle: Bundle) -> DataFrame:
    """(branch, ItemID, GroupName): the item's first live group, main group first.

    The pick is an aggregate (min over (not-main, ItemGroupID)), so a hot
    item is reduced map-side; ties between main groups go to the lowest id.
    The group's own status is checked after the pick: an inactive pick gives
    a null name, and no other group is promoted.
    """
    itg = bundle["item_to_group"].where(master_live(F.col("Status")))
    pick = itg.groupBy("branch", "ItemID").agg(
        F.min(F.struct(F.when(F.col("IsMainGroup") == 1, 0).otherwise(1).alias("k"),
                       F.col("ItemGroupID").alias("g")))["g"].alias("ItemGroupID"))
    ig = bundle["item_group"].where(master_live(F.col("Status"))).select(
        "branch", "ItemGroupID", F.col("ItemGroupName").alias("GroupName"))
    return pick.join(ig, ["branch", "ItemGroupID"], "left").select("branch", "ItemID", "GroupName")


def stock_base(bundle: Bundle, rules: Rules) -> DataFrame:
    """On-hand rows of live item-store pairs joined to their store, item and
    the item-store attributes (the reference's OnHand CTE x ItemStore).

    The self join is on (ItemID, StoreID): 1:1 when that pair is unique,
    as it is in a POS item-store table. Active stores (a broadcast
    dimension) are joined first, which drops closed stores' rows before the
    shuffled joins and keeps the on-hand side's partitioning.
    """
    ist = bundle["item_store"]
    oh = ist.where(fact_live(F.col("Status"))).select(
        "branch", "ItemID", "StoreID", F.col("ItemStoreID").alias("OnHandRowID"),
        F.coalesce(F.col("OnHand"), F.lit(0).cast("decimal(18,1)")).alias("Qty"))
    attrs = ist.select("branch", "ItemID", "StoreID", F.col("ItemStoreID").alias("AttrRowID"),
                       "ReorderPoint", "AVGCost", "AVCostWithoutTax", "CostWithoutTax")
    return (oh.join(live_stores(bundle), ["branch", "StoreID"])
              .join(attrs, ["branch", "ItemID", "StoreID"])
              .join(item_dimension(bundle, rules), ["branch", "ItemID"]))


MONTH = "SaleMonth"


def from_month(facts: DataFrame, since: Column) -> DataFrame:
    """``facts`` without the sale months before ``since``'s, where the table
    stores its sale month.

    Sale and tender lines carry no date. A table written with
    :func:`possum.sources.months.with_sale_months` carries the month of its
    transaction as a partition column, so old months are neither listed nor
    read. Every row of the window has a month of the window: the join to the
    transactions, which follows in each operator, removes the rest. A table
    without the column is returned as it is.
    """
    if MONTH not in facts.columns:
        return facts
    return facts.where(F.col(MONTH) >= F.date_format(since, "yyyy-MM"))
