"""Sales datasets: D9 monthly unit sales, D10-D13 daily totals, D19 hours, D25.

The daily totals (D10-D13) are merged over branches. The reference sums
per-branch lists by the merge key; here one partial/final aggregate runs on
the branch union, grouped by the merge key directly. That is exact: sums
add up either way, and transactions of different branches are different
transactions. (branch, TransactionID) is the key of pos_transaction and the
dimension joins are on dimension keys, so a transaction is one row and the
distinct count of the reference is a row count: no shuffle of the fact, a hot
store or day is combined map-side. Amounts stay DECIMAL; the cast to double is
the last step, in the sink or in ``amounts_out``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.functions import codes
from possum.functions.dates import day_label, lookback, month_label, today_iso
from possum.functions.filters import fact_live, master_live
from possum.functions.money import dec, out, whole
from possum.functions.text import plus, ustrip
from possum.operators.base import from_month, item_dimension, live_stores, main_group
from possum.operators.skew import HeavyKeys, salted_join
from possum.rules import Rules
from possum.sources.sinks import decimals_to_double


def sales_transactions(bundle: Bundle, rules: Rules) -> DataFrame:
    """Live sale transactions of live stores, excluded types removed."""
    t = bundle["pos_transaction"].where(
        fact_live(F.col("Status"))
        & ~F.col("TransactionType").isin(*rules.excluded_transaction_types))
    return t.join(live_stores(bundle), ["branch", "StoreID"])


def _transactions() -> F.Column:
    """Transactions: rows, as (branch, TransactionID) is unique (see the module)."""
    return F.count(F.lit(1)).cast("bigint")


def _by_day(t: DataFrame, *keys: str) -> DataFrame:
    """Sum of Total and transactions by sale day and ``keys``. Rows are grouped
    on the date itself; the label is made once per group."""
    g = t.withColumn("day", F.to_date("SaleTime")).groupBy("day", *keys).agg(
        F.coalesce(F.sum("Total"), F.lit(0)).alias("TotalSales"), _transactions().alias("Transactions"))
    return g.select(day_label(F.col("day")).alias("SaleDate"), *keys, "TotalSales", "Transactions")


def sales_by_store_day(bundle: Bundle, rules: Rules) -> DataFrame:
    """SaleDate, StoreName, TotalSales, Transactions."""
    return _by_day(sales_transactions(bundle, rules), "StoreName")


def sale_lines(bundle: Bundle, rules: Rules, heavy: HeavyKeys | None = None) -> DataFrame:
    """Live sale lines (entry types not excluded) of sale transactions; ``heavy``
    are transactions with a large part of all lines, whose join is salted."""
    te = bundle["transaction_entry"].where(
        fact_live(F.col("Status"))
        & ~F.col("TransactionEntryType").isin(*rules.excluded_entry_types)
    ).select("branch", "TransactionID", "DepartmentID", F.col("Total").alias("LineTotal"))
    t = sales_transactions(bundle, rules).select("branch", "TransactionID", "SaleTime")
    return te.join(t, ["branch", "TransactionID"]) if heavy is None else salted_join(te, t, heavy)


def department_day_sums(bundle: Bundle, rules: Rules, heavy: HeavyKeys | None = None) -> DataFrame:
    """D11 with the number of lines: SaleDate, Dept, TotalSales, Lines. The
    department is the line's own (a small dimension joined before the one
    aggregate)."""
    lines = sale_lines(bundle, rules, heavy).withColumn("SaleDate", day_label(F.col("SaleTime")))
    d = bundle["department"].select("branch", "DepartmentID", F.col("Name").alias("DeptName"))
    labelled = lines.join(d, ["branch", "DepartmentID"], "left").withColumn(
        "Dept", F.coalesce(F.col("DeptName"), F.lit(rules.no_department)))
    g = labelled.groupBy("SaleDate", "Dept").agg(F.sum("LineTotal").alias("TotalSales"), F.count(F.lit(1)).alias("Lines"))
    return g.select("SaleDate", "Dept", F.coalesce(F.col("TotalSales"), F.lit(0)).alias("TotalSales"), "Lines")


def sales_by_department_day(bundle: Bundle, rules: Rules, heavy: HeavyKeys | None = None) -> DataFrame:
    """SaleDate, Dept, TotalSales."""
    return department_day_sums(bundle, rules, heavy).drop("Lines")


def sales_by_seller_day(bundle: Bundle, rules: Rules) -> DataFrame:
    """SaleDate, SellerName, TotalSales, Transactions.

    A seller's name is ``rtrim(first) + ' ' + rtrim(last)``; a missing part or
    an unknown seller gives the unknown label.
    """
    t = sales_transactions(bundle, rules).select("branch", "TransactionID", "SaleTime",
                                                 "SellerID", "Total")
    u = bundle["users"].where(master_live(F.col("Status"))).select(
        "branch", F.col("UserId").alias("SellerID"), "UserFName", "UserLName")
    j = t.join(u, ["branch", "SellerID"], "left").select(
        "Total", "SaleTime",
        F.coalesce(plus(F.rtrim("UserFName"), F.lit(" "), F.rtrim("UserLName")),
                   F.lit(rules.unknown_seller)).alias("SellerName"))
    # grouped by the final label: the reference's groups by raw names merge to it
    return _by_day(j, "SellerName")


def sales_daily(bundle: Bundle, rules: Rules) -> DataFrame:
    """SaleDate, TotalSales, Transactions."""
    return _by_day(sales_transactions(bundle, rules))


def daily_from_stores(stores: DataFrame) -> DataFrame:
    """D13 from D10's rows: per day, the sums of TotalSales and Transactions.

    Equal to :func:`sales_daily`: a transaction has one store (StoreID keys
    the store table) and the sums are exact decimals. The daily job uses it on
    the staged D10, so the full history of transactions is scanned once
    instead of twice.
    """
    g = stores.groupBy("SaleDate").agg(F.sum("TotalSales").alias("TotalSales"),
                                       F.sum("Transactions").alias("Transactions"))
    return g.select("SaleDate", "TotalSales", F.col("Transactions").cast("bigint").alias("Transactions"))


def amounts_out(df: DataFrame) -> DataFrame:
    """The dataset with its exact amounts cast to double, the last step."""
    return decimals_to_double(df)


def sales_by_hour(bundle: Bundle, rules: Rules, as_of: datetime) -> DataFrame:
    """Branch, Hour, StoreName, Transactions, TotalSales over the last 90 days.

    Appended over branches (each branch keeps its own rows)."""
    t = sales_transactions(bundle, rules).where(
        F.col("SaleTime") >= lookback(as_of, rules.hours_days, "DAY"))
    per_store = t.groupBy("branch", F.hour("SaleTime").alias("Hour"), "StoreID", "StoreName").agg(
        _transactions().alias("Transactions"),
        dec(F.coalesce(F.sum("Total"), F.lit(0)), 2).alias("TotalSales"))
    return per_store.select("branch", F.col("Hour").cast("int").alias("Hour"), "StoreName",
                            "Transactions", out(F.col("TotalSales")).alias("TotalSales"))


def today_total(stores: DataFrame, as_of: datetime) -> DataFrame:
    """One row, today's total over the store list (0 when there is none)."""
    day = today_iso(as_of)
    return stores.where(F.col("SaleDate") == F.lit(day)).agg(
        F.lit(day).alias("today"), F.coalesce(F.sum("TotalSales"), F.lit(0)).alias("TodayTotal"))


def today_total_from_sales(bundle: Bundle, rules: Rules, as_of: datetime) -> DataFrame:
    """D25 without a staged D10: the day's range of SaleTime reaches the scan,
    so one day is read, not the history."""
    start = F.date_trunc("day", F.lit(as_of)).cast("timestamp_ntz")
    t = from_month(bundle["pos_transaction"], start).where(
        (F.col("SaleTime") >= start) & (F.col("SaleTime") < start + F.expr("INTERVAL 1 DAY")))
    return today_total(sales_by_store_day(bundle.with_tables(pos_transaction=t), rules), as_of)


def sales_item_dimension(bundle: Bundle, rules: Rules) -> DataFrame:
    """Item attributes of the sales and stock reports: labels, trimmed name,
    model code and size."""
    items = item_dimension(bundle, rules).join(main_group(bundle), ["branch", "ItemID"], "left")
    return items.select(
        "branch", "ItemID",
        F.coalesce(F.col("DeptName"), F.lit(rules.no_department)).alias("dept"),
        F.coalesce(F.col("GroupName"), F.lit(rules.no_group)).alias("g"),
        ustrip(F.col("Name")).alias("n"),
        codes.model_code(F.col("BarcodeNumber")).alias("mc"),
        codes.size_code(F.col("BarcodeNumber")).alias("sz"))


def monthly_sales(bundle: Bundle, rules: Rules, as_of: datetime) -> DataFrame:
    """Units sold in the last 13 months by month, department, main group,
    trimmed name, model code, size and store; positive totals only.

    Lines are first summed per (month, store, item-store) right after the
    one fact-fact join, so the dimension joins see one row per item, store
    and month instead of one per sale line. Lines carry no date; lines stored
    with their sale month skip older months at the scan.
    """
    since = lookback(as_of, rules.sales_months, "MONTH")
    te = from_month(bundle["transaction_entry"], since).where(
        fact_live(F.col("Status"))
        & ~F.col("TransactionEntryType").isin(*rules.excluded_entry_types)
    ).select("branch", "TransactionID", "ItemStoreID", "Qty")
    t = from_month(bundle["pos_transaction"], since).where(
        fact_live(F.col("Status")) & (F.col("SaleTime") >= since)
    ).select("branch", "TransactionID", "StoreID", month_label(F.col("SaleTime")).alias("ym"))
    per_item_store = te.join(t, ["branch", "TransactionID"]).groupBy(
        "branch", "ym", "StoreID", "ItemStoreID").agg(F.sum("Qty").alias("QtySold"))
    ist = bundle["item_store"].where(fact_live(F.col("Status"))).select("branch", "ItemStoreID", "ItemID")
    j = (per_item_store.join(ist, ["branch", "ItemStoreID"])
         .join(sales_item_dimension(bundle, rules), ["branch", "ItemID"])
         .join(live_stores(bundle).select("branch", "StoreID", F.col("StoreName").alias("st")),
               ["branch", "StoreID"]))
    res = j.groupBy("branch", "ym", "dept", "g", "n", "mc", "sz", "st").agg(
        F.sum("QtySold").alias("q"))
    return res.where(F.col("q") > 0).select(
        "branch", "ym", "dept", "g", "n", "mc", "sz", "st", whole(F.col("q")).cast("bigint").alias("q"))
