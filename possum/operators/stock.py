"""Stock datasets: D1 store summary, D2 low stock, D3 by department,
D4 stock lines, D5 item catalogue, D9b stock report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.functions import codes
from possum.functions.money import cost_ladder, dec, out
from possum.functions.text import or_empty, ustrip
from possum.operators.base import main_group, stock_base
from possum.rules import Rules


def _base(bundle: Bundle, rules: Rules, base: DataFrame | None) -> DataFrame:
    """The stock base, or a materialized copy of it passed by a job plan."""
    return stock_base(bundle, rules) if base is None else base


def _positive_qty():
    return F.when(F.col("Qty") > 0, F.col("Qty")).otherwise(F.lit(0))


def _stock_value():
    return F.when(F.col("Qty") > 0, F.col("Qty") * F.coalesce(F.col("AVGCost"), F.lit(0))).otherwise(F.lit(0))


def stock_summary(bundle: Bundle, rules: Rules, base: DataFrame | None = None) -> DataFrame:
    """Per active store: SKUs, in-stock / zero / low counts, units, value.

    Columns: branch, StoreName, StoreCode, TotalSKUs, InStock, ZeroStock,
    LowStock, TotalUnits, StockValue (decimal), Sort, StoreNameOrig.
    """
    b = _base(bundle, rules, base)
    q, rp = F.col("Qty"), F.col("ReorderPoint")
    low = rp.isNotNull() & (q >= 0) & (q <= rp) & (rp > 0)
    agg = b.groupBy("branch", "StoreID", "StoreName", "StoreNameOrig", "Code", "Sort").agg(
        F.count(F.lit(1)).alias("TotalSKUs"),
        F.sum(F.when(q > 0, 1).otherwise(0)).alias("InStock"),
        F.sum(F.when(q == 0, 1).otherwise(0)).alias("ZeroStock"),
        F.sum(F.when(low, 1).otherwise(0)).alias("LowStock"),
        dec(F.sum(_positive_qty()), 1).alias("TotalUnits"),
        dec(F.sum(_stock_value()), 0).alias("StockValue"))
    return agg.select("branch", "StoreName", F.col("Code").alias("StoreCode"),
                      F.col("TotalSKUs").cast("bigint").alias("TotalSKUs"),
                      F.col("InStock").cast("bigint").alias("InStock"),
                      F.col("ZeroStock").cast("bigint").alias("ZeroStock"),
                      F.col("LowStock").cast("bigint").alias("LowStock"),
                      "TotalUnits", "StockValue", "Sort", "StoreNameOrig")


def finish_stock_summary(summary: DataFrame) -> DataFrame:
    """Final projection of D1 (amounts as double)."""
    return summary.select("branch", "StoreName", "StoreCode", "TotalSKUs", "InStock", "ZeroStock",
                          "LowStock", out(F.col("TotalUnits")).alias("TotalUnits"),
                          out(F.col("StockValue")).alias("StockValue"), "Sort")


# ask low_stock for every row under its reorder point, unranked
ALL_ROWS = -1


def low_stock(bundle: Bundle, rules: Rules, n: int | None = None,
              base: DataFrame | None = None) -> DataFrame:
    """Items at or under their reorder point, largest shortage first.

    Top ``n`` (300) per branch, ranked 1..n in ``Rank``. Planned as a
    window with a group limit (WindowGroupLimit) that also runs before the
    shuffle, so each task ships at most n rows per branch, however large
    a branch is. The order ends in row ids, so the cut at n is unique.
    ``n=ALL_ROWS`` gives every such row, with a null Rank and no window.
    """
    n = rules.low_stock_limit if n is None else n
    b = _base(bundle, rules, base)
    q, rp = F.col("Qty"), F.col("ReorderPoint")
    cand = b.where(rp.isNotNull() & (rp > 0) & (q >= 0) & (q <= rp)).select(
        "branch", "Name", "BarcodeNumber", "ModelNumber", "StoreName",
        dec(q, 1).alias("OnHand"), dec(rp, 1).alias("ReorderPoint"),
        cost_ladder(F.col("AVCostWithoutTax"), F.col("CostWithoutTax"), F.col("AVGCost"),
                    rules.vat).alias("Price"),
        F.col("DeptName").alias("Department"),
        (q - rp).alias("_short"), "Sort", "StoreID", "ItemID", "OnHandRowID", "AttrRowID")
    order = [F.col("_short").asc(), F.col("Sort").asc_nulls_first(), F.col("StoreID").asc(),
             F.col("ItemID").asc(), F.col("OnHandRowID").asc(), F.col("AttrRowID").asc()]
    w = Window.partitionBy("branch").orderBy(*order)
    if n == ALL_ROWS:
        ranked = cand.withColumn("Rank", F.lit(None).cast("int"))
    else:
        ranked = cand.withColumn("Rank", F.row_number().over(w)).where(F.col("Rank") <= n)
    return ranked.select("branch", F.col("Rank").cast("bigint").alias("Rank"), "Name", "BarcodeNumber", "ModelNumber", "StoreName",
                         out(F.col("OnHand")).alias("OnHand"),
                         out(F.col("ReorderPoint")).alias("ReorderPoint"),
                         out(F.col("Price")).alias("Price"), "Department")


def stock_by_department(bundle: Bundle, rules: Rules, base: DataFrame | None = None) -> DataFrame:
    """D3: in-stock SKUs, units and value by department and store.

    Columns: branch, Department, StoreName, InStock, TotalUnits, Value
    (decimal), Sort, StoreNameOrig.
    """
    b = _base(bundle, rules, base).where(F.col("Qty") > 0)
    agg = b.groupBy("branch", "DeptName", "StoreNameOrig", "StoreName", "Sort").agg(
        F.sum(F.when(F.col("Qty") > 0, 1).otherwise(0)).alias("InStock"),
        dec(F.sum(_positive_qty()), 1).alias("TotalUnits"),
        dec(F.sum(_stock_value()), 0).alias("Value"),
        F.sum("Qty").alias("_units"))
    return agg.where(F.col("_units") > 0).select(
        "branch", F.coalesce(F.col("DeptName"), F.lit(rules.no_department)).alias("Department"),
        "StoreName", F.col("InStock").cast("bigint").alias("InStock"), "TotalUnits", "Value",
        "Sort", "StoreNameOrig")


def finish_stock_by_department(by_dept: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Final projection of D3 (amounts as double); ``extra`` columns pass through."""
    return by_dept.select("branch", "Department", "StoreName", "InStock",
                          out(F.col("TotalUnits")).alias("TotalUnits"),
                          out(F.col("Value")).alias("Value"), *extra)


def stock_lines(bundle: Bundle, rules: Rules, base: DataFrame | None = None) -> DataFrame:
    """Item x store lines in stock with the resolved unit cost (decimal)."""
    b = _base(bundle, rules, base).where(F.col("Qty") > 0)
    return b.select("branch", "ItemID", "OnHandRowID", "AttrRowID", "Name", "BarcodeNumber",
                    "ModelNumber", "StoreName", "StoreNameOrig", dec(F.col("Qty"), 1).alias("Qty"),
                    F.col("DeptName").alias("Department"),
                    cost_ladder(F.col("AVCostWithoutTax"), F.col("CostWithoutTax"),
                                F.col("AVGCost"), rules.vat).alias("Price"))


def item_catalogue(lines: DataFrame) -> DataFrame:
    """One row per (branch, key), key = trimmed barcode, else the name.

    ``n``, ``b``, ``mn``, ``d`` come from the key's lowest ItemID; ``p`` is the
    highest known cost (0 when none); ``s`` maps store -> quantity, where a
    store listed twice keeps the line of the highest ItemID; ``q`` adds all
    lines. Two aggregates, per (key, store) then per key: each is reduced
    map-side, and a key's map holds at most one entry per store.
    """
    bc = ustrip(or_empty(F.col("BarcodeNumber")))
    keyed = lines.withColumn("key", F.when(bc != "", bc).otherwise(F.col("Name")))
    line_order = F.struct("ItemID", "OnHandRowID", "AttrRowID")
    per_store = keyed.groupBy("branch", "key", "StoreNameOrig").agg(
        F.max_by("Qty", line_order).alias("last_qty"),
        F.sum("Qty").alias("qty"),
        F.max("Price").alias("price"),
        F.min(F.struct(line_order.alias("o"), F.col("Name").alias("n"),
                       or_empty(F.col("BarcodeNumber")).alias("b"),
                       or_empty(F.col("ModelNumber")).alias("mn"),
                       or_empty(F.col("Department")).alias("d"))).alias("first"))
    per_key = per_store.groupBy("branch", "key").agg(
        F.min("first").alias("first"),
        F.max("price").alias("price"),
        F.sum("qty").alias("q"),
        F.map_from_entries(F.collect_list(F.struct("StoreNameOrig", "last_qty"))).alias("s"))
    return per_key.select(
        "branch", "key", F.col("first.n").alias("n"), F.col("first.b").alias("b"),
        F.col("first.mn").alias("mn"), F.col("first.d").alias("d"),
        F.greatest(F.coalesce(F.col("price"), F.lit(0).cast("decimal(18,2)")),
                   F.lit(0).cast("decimal(18,2)")).alias("p"),
        "s", "q")


def finish_catalogue(items: DataFrame) -> DataFrame:
    """Final projection of D5-D8 items: map and amounts as double."""
    return items.select("branch", "key", "n", "b", "mn", "d", out(F.col("p")).alias("p"),
                        F.col("s").cast("map<string,double>").alias("s"),
                        out(F.col("q")).alias("q"))


def flatten_catalogue(items: DataFrame) -> DataFrame:
    """One row per map entry (for value checks)."""
    f = finish_catalogue(items)
    return f.select("branch", "key", "n", "b", "mn", "d", "p", "q",
                    F.explode("s").alias("store", "store_qty"))


def stock_report(bundle: Bundle, rules: Rules, base: DataFrame | None = None) -> DataFrame:
    """Stock (qty >= 0) by department, group, trimmed name, model code
    and size, with a store -> qty map and the total."""
    b = _base(bundle, rules, base).where(F.col("Qty") >= 0).join(
        main_group(bundle), ["branch", "ItemID"], "left")
    keyed = b.select(
        "branch", "StoreNameOrig", "Qty",
        F.coalesce(F.col("DeptName"), F.lit(rules.no_department)).alias("dept"),
        F.coalesce(F.col("GroupName"), F.lit(rules.no_group)).alias("g"),
        ustrip(F.col("Name")).alias("n"),
        codes.model_code(F.col("BarcodeNumber")).alias("mc"),
        codes.size_code(F.col("BarcodeNumber")).alias("sz"))
    keys = ["branch", "dept", "g", "n", "mc", "sz"]
    per_store = keyed.groupBy(*keys, "StoreNameOrig").agg(F.sum("Qty").alias("qty"))
    return per_store.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("StoreNameOrig", "qty"))).alias("s"),
        F.sum("qty").alias("q"))


def finish_stock_report(report: DataFrame) -> DataFrame:
    return report.select("branch", "dept", "g", "n", "mc", "sz",
                         F.col("s").cast("map<string,double>").alias("s"),
                         out(F.col("q")).alias("q"))


def flatten_stock_report(report: DataFrame) -> DataFrame:
    f = finish_stock_report(report)
    return f.select("branch", "dept", "g", "n", "mc", "sz", "q",
                    F.explode("s").alias("store", "store_qty"))
