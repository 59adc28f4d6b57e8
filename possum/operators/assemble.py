"""D23 date documents, D24 external net-amount feed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.functions.dates import day_key_to_iso, today_iso

FAMILIES = ("stores", "depts", "sellers", "payments")


def _order(field: str, descending: bool = False):
    """array_sort comparator on one struct field, nulls last (a total order)."""
    def cmp(a, b):
        x, y = (b[field], a[field]) if descending else (a[field], b[field])
        return (F.when(a[field].isNull() & b[field].isNull(), 0)
                .when(a[field].isNull(), 1).when(b[field].isNull(), -1)
                .when(x < y, -1).when(x > y, 1).otherwise(0))
    return cmp


def day_documents(stores: DataFrame, depts: DataFrame, sellers: DataFrame,
                  payments: DataFrame) -> DataFrame:
    """SaleDate, stores, depts, sellers, payments (arrays of structs).

    One row per date present in any family; a family without rows that day
    has an empty list. The four inputs are unioned, each carrying its struct
    in its own column, and one aggregate per date collects them
    (collect_list skips the nulls of the other families): one shuffle, no
    joins. A list holds at most one entry per store, department, seller or
    (store, method) of that day.
    """
    fams = {
        "stores": stores.select("SaleDate", F.struct("StoreName", "TotalSales", "Transactions").alias("v")),
        "depts": depts.select("SaleDate", F.struct("Dept", "TotalSales").alias("v")),
        "sellers": sellers.select("SaleDate", F.struct("SellerName", "TotalSales", "Transactions").alias("v")),
        "payments": payments.select("SaleDate", F.struct("StoreName", "PayMethod", "TotalAmount",
                                                         "Cnt").alias("v")),
    }
    typed = {f: df.schema["v"].dataType for f, df in fams.items()}
    parts = []
    for f, df in fams.items():
        cols = [F.col("SaleDate")] + [
            (F.col("v") if g == f else F.lit(None).cast(typed[g])).alias(g) for g in FAMILIES]
        parts.append(df.select(*cols))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    g = u.groupBy("SaleDate").agg(*[F.collect_list(f).alias(f) for f in FAMILIES])
    return g.select(
        "SaleDate",
        F.array_sort("stores", _order("StoreName")).alias("stores"),
        F.array_sort("depts", _order("TotalSales", descending=True)).alias("depts"),
        F.array_sort("sellers", _order("TotalSales", descending=True)).alias("sellers"),
        F.array_sort("payments", _order("TotalAmount", descending=True)).alias("payments"))


def flatten_day_documents(docs: DataFrame) -> DataFrame:
    """One row per list element; an empty list gives one row of nulls. The four
    lists become one array, exploded once."""
    spec = {"stores": ("StoreName", None, "TotalSales", "Transactions"),
            "depts": ("Dept", None, "TotalSales", None),
            "sellers": ("SellerName", None, "TotalSales", "Transactions"),
            "payments": ("StoreName", "PayMethod", "TotalAmount", "Cnt")}

    def row(fam, name, method, amount, count):
        return F.struct(F.lit(fam).alias("family"), name.cast("string").alias("name"), method.cast("string").alias("method"),
                        amount.cast("double").alias("amount"), count.cast("bigint").alias("cnt"))

    none = F.lit(None)

    def from_entry(fam, name, method, amount, count):
        return lambda e: row(fam, e[name], e[method] if method else none, e[amount], e[count] if count else none)

    lists = []
    for fam, (name, method, amount, count) in spec.items():
        rows = F.transform(fam, from_entry(fam, name, method, amount, count))
        lists.append(F.when(F.size(fam) > 0, rows).otherwise(F.array(row(fam, none, none, none, none))))
    return docs.select("SaleDate", F.explode(F.concat(*lists)).alias("e")).select("SaleDate", "e.*")


def net_feed_days(feed: DataFrame) -> DataFrame:
    """(day, net) with ``d/m/yyyy`` keys re-keyed to ISO dates.

    ``feed`` has day_key (string) and net; optional columns are kept alongside:
    raw (the entry's JSON text) and session_ok. Unparsable keys stay as they
    are. Of several entries of one day one whole entry is kept: the latest
    fetched (``fetched``, when the feed has it), then the greatest file name,
    then the greatest raw key.
    """
    order = [c for c in ("fetched", "file", "day_key") if c in feed.columns]
    kept = ["net", *[c for c in ("raw", "session_ok") if c in feed.columns]]
    keyed = feed.select(day_key_to_iso(F.col("day_key")).alias("day"), *order, *kept)
    picked = keyed.groupBy("day").agg(F.max_by(F.struct(*kept), F.struct(*order)).alias("e"))
    return picked.select("day", *[F.col(f"e.{c}").alias(c) for c in kept])


def net_feed_today(days: DataFrame, as_of: datetime) -> DataFrame:
    """One row: today's ISO date and its net amount (null when absent), and, for
    a feed that has them, its raw entry and sessionOk (when the entry is an object)."""
    day = today_iso(as_of)
    today = F.col("day") == F.lit(day)
    extra = [F.max(F.when(today, F.col("raw"))).alias("raw")] if "raw" in days.columns else []
    if "session_ok" in days.columns:
        is_object = today & F.ltrim("raw").startswith("{")
        extra.append(F.max(F.when(is_object, F.col("session_ok"))).alias("sessionOk"))
    return days.agg(F.lit(day).alias("day"), F.max(F.when(today, F.col("net"))).alias("net"), *extra)
