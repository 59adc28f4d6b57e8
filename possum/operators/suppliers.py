"""D17 supplier documents by month, D18 supplier document detail."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.functions.dates import day_label, lookback, month_label
from possum.functions.filters import doc_live
from possum.functions.money import dec, out
from possum.rules import Rules


def doc_type_label(code: Column, rules: Rules) -> Column:
    expr = None
    for k, label in rules.doc_type_labels:
        expr = F.when(code == k, label) if expr is None else expr.when(code == k, label)
    return expr.otherwise(code.cast("string"))


def _documents(bundle: Bundle, rules: Rules, since: Column) -> DataFrame:
    """Live documents of the wanted types and states since ``since``, each
    joined to the totals of its live lines.

    Lines are reduced per document id before the join (partial aggregate),
    so the join sees one row per document on both sides, and both sides
    are hash-partitioned on the same key. Lines carry no date, so all of
    them are read once.
    """
    sd = bundle["suppliers_docs"].where(
        doc_live(F.col("Status")) & ~F.col("Type").isin(*rules.excluded_doc_types)
        & F.col("DocStatus").isin(*rules.doc_states) & (F.col("DateT") >= since))
    entries = bundle["suppliers_docs_entry"].where(doc_live(F.col("Status")))
    lines = entries.groupBy("branch", "ID").agg(
        F.count(F.lit(1)).alias("LineCount"), F.sum("Qty").alias("LineQty"),
        F.sum(F.coalesce(F.col("ExtPrice"), F.col("Cost") * F.col("Qty"))).alias("LineAmount"))
    sup = bundle["supplier_dim"].select("branch", "SupplierID", F.col("Name").alias("SupName"))
    return sd.join(lines, ["branch", "ID"]).join(sup, ["branch", "SupplierID"], "left")


def supplier_monthly(bundle: Bundle, rules: Rules, as_of: datetime) -> DataFrame:
    """Branch, YearMonth, SupplierName, DocType, DocCount, TotalAmount (3 years)."""
    docs = _documents(bundle, rules, lookback(as_of, rules.supplier_monthly_years, "YEAR"))
    g = docs.groupBy("branch", month_label(F.col("DateT")).alias("YearMonth"), "SupName", "Type").agg(
        F.countDistinct("ID").alias("DocCount"), dec(F.sum("LineAmount"), 2).alias("TotalAmount"))
    return _monthly_out(g, rules)


def _monthly_out(g: DataFrame, rules: Rules) -> DataFrame:
    return g.select("branch", "YearMonth",
                    F.coalesce(F.col("SupName"), F.lit(rules.no_supplier)).alias("SupplierName"),
                    doc_type_label(F.col("Type"), rules).alias("DocType"),
                    F.col("DocCount").cast("bigint").alias("DocCount"),
                    out(F.coalesce(F.col("TotalAmount"), F.lit(0))).alias("TotalAmount"))


_MONTH_KEYS = ["branch", "YearMonth", "SupName", "Type"]


def supplier_month_state(bundle: Bundle, rules: Rules, as_of: datetime) -> DataFrame:
    """D17 as a state that can be kept and merged: branch, YearMonth, SupName,
    Type, word, bits, amount.

    The documents of a group are a bitmap: bit ``ID % 64`` of the word
    ``ID div 64``. Dense ids take a 64th of a row each, sparse ones a row: a
    fixed block of 4 kB per group, as the bitmap functions have it, would be
    mostly empty for a supplier's few documents. One exchange, on (group, word),
    so a group with a third of all documents is spread.
    """
    docs = _documents(bundle, rules, lookback(as_of, rules.supplier_monthly_years, "YEAR"))
    bit = F.expr("shiftleft(1L, cast(pmod(ID, 64) as int))")
    return docs.groupBy("branch", month_label(F.col("DateT")).alias("YearMonth"), "SupName", "Type",
                        F.expr("(ID - pmod(ID, 64)) div 64").alias("word")).agg(
        F.bit_or(bit).alias("bits"), F.sum("LineAmount").alias("amount"))


def merge_month_states(*states: DataFrame) -> DataFrame:
    """States of different lines merged: a document that several of them hold counts once."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return both.groupBy(*_MONTH_KEYS, "word").agg(F.bit_or("bits").alias("bits"), F.sum("amount").alias("amount"))


def supplier_monthly_from_state(state: DataFrame, rules: Rules) -> DataFrame:
    """D17 from its state: exact distinct documents as the number of set bits."""
    g = state.groupBy(*_MONTH_KEYS).agg(F.sum(F.bit_count("bits")).alias("DocCount"), dec(F.sum("amount"), 2).alias("TotalAmount"))
    return _monthly_out(g, rules)


def supplier_documents(bundle: Bundle, rules: Rules, as_of: datetime) -> DataFrame:
    """One row per document attributes (not per id), 14 months.

    branch, DocDate, SupplierName, DocNumber, DocType, StoreName, IsPaid,
    AmountPay, LineCount, TotalQty, TotalAmount.
    """
    docs = _documents(bundle, rules, lookback(as_of, rules.supplier_docs_months, "MONTH"))
    st = bundle["store"].select("branch", "StoreID", "StoreName")
    docs = docs.join(st, ["branch", "StoreID"], "left")
    g = docs.groupBy("branch", "DateT", "SupName", "No", "Type", "StoreName", "IsPaid", "AmountPay").agg(
        F.sum("LineCount").alias("LineCount"), dec(F.sum("LineQty"), 1).alias("TotalQty"),
        dec(F.sum("LineAmount"), 2).alias("TotalAmount"))
    zero = F.lit(0)
    return g.select(
        "branch", day_label(F.col("DateT")).alias("DocDate"),
        F.coalesce(F.col("SupName"), F.lit(rules.no_supplier)).alias("SupplierName"),
        F.coalesce(F.col("No"), F.lit("")).alias("DocNumber"),
        doc_type_label(F.col("Type"), rules).alias("DocType"),
        F.coalesce(F.col("StoreName"), F.lit("")).alias("StoreName"),
        F.coalesce(F.col("IsPaid"), zero).cast("int").alias("IsPaid"),
        out(dec(F.coalesce(F.col("AmountPay"), zero), 2)).alias("AmountPay"),
        F.col("LineCount").cast("bigint").alias("LineCount"),
        out(F.coalesce(F.col("TotalQty"), zero)).alias("TotalQty"),
        out(F.coalesce(F.col("TotalAmount"), zero)).alias("TotalAmount"))
