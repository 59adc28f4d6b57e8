"""Registered datasets on the driver fixtures: name -> (spark, sf_dir) -> DataFrame.

Every dataset runs over the whole driver tables, projected onto the
canonical POS views (FIXTURES.md), with the fixture parameters of
``params.py``. Nested outputs (store maps, punch lists, the promotion
matrix, date documents) are flattened to one row per entry so values can be
hashed; the nested forms are checked in ``tests/``. ``on_bundle`` runs the
same definitions over any canonical bundle (the bench and the plan checks
use staged Parquet).
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from possum_checks.params import AS_OF, AS_OF_PEOPLE, LABEL_B, PRICE_LIST, RULES
from possum.bundle import Bundle
from possum.functions.money import out
from possum.operators import (assemble, attendance, branches, ledger, payments, people, pricing,
                              promotions, sales, skew, stock, suppliers)
from possum.operators.base import stock_base
from possum.operators.daysums import DAY_SUMS, day_sums
from possum.plans.common import Stage, write_ordered
from possum.plans.daily_job import ORDER, published, run_daily_job
from possum.sources.adapters import fixture_bundle, split_branches
from possum.sources.feed import read_feed
from possum.streaming.feed import read_days, start_feed
from possum.sources.optional import optional_table
from possum.sources.parquet import write_bundle
from possum.sources.sinks import positions, seal, unseal, with_places
from possum.streaming import retract


def catalogue(b: Bundle) -> DataFrame:
    return stock.item_catalogue(stock.stock_lines(b, RULES))


def imputed(b: Bundle) -> DataFrame:
    # read three times: staged in the shared folder, as the stock job does
    return pricing.impute_cost(Stage(b.spark, "catalogue").put("items", catalogue(b)))


def priced(b: Bundle) -> DataFrame:
    return pricing.apply_price_list(imputed(b), PRICE_LIST)


def items_flat(items: DataFrame) -> DataFrame:
    return items.select("branch", "key", "n", "b", "mn", "d", out(F.col("p")).alias("p"),
                        out(F.col("q")).alias("q"))


def revalued(b: Bundle) -> tuple[DataFrame, DataFrame]:
    stage = Stage(b.spark, "revalue")
    base = stage.put("stock_base", stock_base(b, RULES))
    items = stage.put("catalogue", stock.item_catalogue(stock.stock_lines(b, RULES, base=base)))
    items = pricing.apply_price_list(pricing.impute_cost(items), PRICE_LIST)
    return pricing.revalue_stock(stock.stock_summary(b, RULES, base=base),
                                 stock.stock_by_department(b, RULES, base=base), items, RULES)


def stock_lines_out(b: Bundle) -> DataFrame:
    lines = stock.stock_lines(b, RULES)
    return lines.select("branch", "Name", "BarcodeNumber", "ModelNumber", "StoreName",
                        out(F.col("Qty")).alias("Qty"), "Department", out(F.col("Price")).alias("Price"))


Parts = list[tuple[Bundle, "str | None"]]


def relabelled_catalogue(parts: Parts) -> DataFrame:
    u = branches.union_branches(parts)
    return stock.flatten_catalogue(branches.relabel_branch(catalogue(u), u))


def merged_sellers(parts: Parts) -> DataFrame:
    per_branch = None
    for rank, (bundle, _label) in enumerate(parts):
        df = sales.sales_by_seller_day(bundle, RULES).withColumn("rank", F.lit(rank))
        per_branch = df if per_branch is None else per_branch.unionByName(df)
    m = branches.merge_sum(per_branch, ["SaleDate", "SellerName"], ["TotalSales", "Transactions"], ["rank"])
    return sales.amounts_out(m.select("SaleDate", "SellerName", "TotalSales", "Transactions"))


def deduped_users(parts: Parts) -> DataFrame:
    u = branches.union_branches(parts)
    return people.dedupe_first(people.user_directory(u, RULES), u, ["user", "hash"], ["no"])


def branch_sales(parts: Parts) -> DataFrame:
    return sales.amounts_out(sales.sales_by_store_day(branches.union_branches(parts), RULES))


def branch_monthly_sales(parts: Parts) -> DataFrame:
    return sales.monthly_sales(branches.union_branches(parts), RULES, AS_OF)


def day_docs(b: Bundle) -> DataFrame:
    return assemble.day_documents(sales.sales_by_store_day(b, RULES), sales.sales_by_department_day(b, RULES),
                                  sales.sales_by_seller_day(b, RULES), payments.payments_by_day(b, RULES))


def changed_rows(now: DataFrame, kept: Column, altered: dict[str, Column]) -> DataFrame:
    """The images of ``now`` against the table as it was (its ``kept`` rows, columns ``altered``) that don't cancel out.

    A row that was as it is now cancels itself out where it is read; the other
    images are netted over the table.
    """
    columns = now.columns
    row = F.struct(*columns)
    was = F.when(kept, F.struct(*[altered[c].alias(c) if c in altered else F.col(c) for c in columns]))
    both = now.select(row.alias("a"), was.alias("b")).where(~F.col("a").eqNullSafe(F.col("b")))
    sides = F.array(F.struct(F.col("a").alias("r"), F.lit(1).alias("Sign")), F.struct(F.col("b").alias("r"), F.lit(-1).alias("Sign")))
    images = both.select(F.explode(sides).alias("e")).where(F.col("e.r").isNotNull()).select("e.r.*", "e.Sign")
    net = images.groupBy(*columns).agg(F.sum("Sign").alias("net")).where("net <> 0")
    return net.withColumn("Sign", F.explode(F.array_repeat(F.signum("net").cast("int"), F.abs("net").cast("int")))).drop("net")


def changed_days(b: Bundle) -> DataFrame:
    """D10, D11, D12 and D14 by retraction: the day sums of the tables as they were
    (times, totals, sellers and states of transactions, lines and tenders differ
    or are missing), and the differences that the images of all changes make."""
    now = {n: b[n] for n in retract.CHANGE_TABLES}
    i = F.col("TransactionID")
    # kept rows, and the columns that were otherwise
    altered = {
        "pos_transaction": (i % 19 != 0, {
            "SaleTime": F.when(i % 11 == 0, F.col("SaleTime") - F.expr("INTERVAL 40 DAY")).otherwise(F.col("SaleTime")),
            "Status": F.when(i % 13 == 0, -F.col("Status")).otherwise(F.col("Status")).cast("int"),
            "Total": F.when(i % 17 == 0, F.col("Total") + 5).otherwise(F.col("Total")).cast("decimal(18,2)"),
            "SellerID": F.when(i % 7 == 0, F.lit(None)).otherwise(F.col("SellerID")).cast("bigint")}),
        "transaction_entry": (F.col("TransactionEntryID") % 23 != 0, {
            "Total": F.when(i % 5 == 0, -F.col("Total")).otherwise(F.col("Total")).cast("decimal(18,2)")}),
        "tender_entry": (i % 29 != 0, {"Amount": F.when(i % 3 == 0, F.col("Amount") * 2).otherwise(F.col("Amount")).cast("decimal(18,2)")}),
    }
    was = {name: now[name].where(kept).withColumns(columns) for name, (kept, columns) in altered.items()}
    stage = Stage(b.spark, "changed-days")
    changes = {name: stage.put(name, changed_rows(now[name], *altered[name])) for name in now}
    before = b.with_tables(**was)
    differences = retract.day_differences(b, RULES, changes, put=stage.put)
    parts = []
    for name, (keys, _, _) in DAY_SUMS.items():
        sums = retract.merge(day_sums(name, before, RULES), differences[name])
        labels = [F.col(k) for k in keys] + [F.lit("")] * (3 - len(keys))
        parts.append(sums.select(F.lit(name).alias("dataset"), *[c.alias(a) for c, a in zip(labels, ("SaleDate", "label", "method"), strict=True)],
                                 out(F.col("Amount")).alias("amount"), F.col("Rows").alias("n")))
    return reduce(DataFrame.unionByName, parts)


def heavy_lines(b: Bundle) -> skew.HeavyKeys:
    # the tables' largest transactions hold few lines: a low share, so that several are salted
    return skew.heavy_keys(b["transaction_entry"], ["branch", "TransactionID"], share=1e-3)


def long_price_list(b: Bundle) -> DataFrame:
    """A price list with an entry for every item: its name from the third character on."""
    im = b["item_main"]
    return im.select(F.col("ItemID").alias("position"), F.substring("Name", 3, 100).alias("name"),
                     (F.col("ItemID") % 1000 + F.lit(1)).cast("decimal(18,2)").alias("price"))


def merged_supplier_months(b: Bundle) -> DataFrame:
    """D17 from two states, one of the lines with an even item count and one of the others, merged."""
    e = b["suppliers_docs_entry"]
    even = F.col("Qty") % 2 == 0
    states = [suppliers.supplier_month_state(b.with_tables(suppliers_docs_entry=e.where(part)), RULES, AS_OF)
              for part in (even, ~even | even.isNull())]
    return suppliers.supplier_monthly_from_state(suppliers.merge_month_states(*states), RULES)


def refilled_cost(b: Bundle) -> DataFrame:
    """D6 from a kept state: the costs by prefix of the items as they were (some
    dearer, some unknown, some not there), changed by the items that differ."""
    stage = Stage(b.spark, "refilled")
    items = stage.put("items", catalogue(b))
    h = F.pmod(F.xxhash64("key"), F.lit(7))
    was = items.where(h != 0).withColumn("p", F.when(h == 1, F.col("p") * 3).when(h == 2, 0).otherwise(F.col("p")).cast(items.schema["p"].dataType))
    net = (items.select("branch", "b", "p", F.lit(1).alias("s")).unionByName(was.select("branch", "b", "p", F.lit(-1).alias("s")))
           .groupBy("branch", "b", "p").agg(F.sum("s").alias("s")).where("s <> 0"))
    net = stage.put("net", net.withColumn("s", F.explode(F.array_repeat(F.signum("s").cast("int"), F.abs("s").cast("int")))))
    state = pricing.change_multiset(pricing.cost_multiset(was), net.where("s < 0"), net.where("s > 0"))
    return items_flat(pricing.impute_cost(items, pricing.highest_costs(state)))


def out_folder(b: Bundle, name: str) -> str:
    return Stage(b.spark, name).root


# datasets of the daily bundle that are counted after reading them back: amount column
BUNDLE_AMOUNTS = {"daily": "TotalSales", "stores": "TotalSales", "depts": "TotalSales", "sellers": "TotalSales",
                  "payments": "TotalAmount", "ledger_monthly": "Total", "ledger_invoices": "TtlMam",
                  "sup_monthly": "TotalAmount", "sup_docs": "TotalAmount", "hours_by_store": "TotalSales",
                  "today_total": "TodayTotal"}


def daily_bundle(b: Bundle) -> DataFrame:
    """The whole daily job, read back: rows and amount of each written dataset."""
    out_dir = out_folder(b, "daily-bundle")
    run_daily_job(b, RULES, AS_OF, out_dir)
    folder = published(b.spark, out_dir)
    parts = []
    for name, amount in BUNDLE_AMOUNTS.items():
        back = b.spark.read.json(os.path.join(folder, name))
        parts.append(back.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n"),
                              out(F.sum(F.col(amount).cast("decimal(28,2)"))).alias("amount")))
    return reduce(DataFrame.unionByName, parts)


def written_order(b: Bundle) -> DataFrame:
    """O1: the hours dataset written in order and read back with each row's position."""
    path = os.path.join(out_folder(b, "written-order"), "hours_by_store")
    write_ordered(b, sales.sales_by_hour(b, RULES, AS_OF), path, ORDER["hours_by_store"], "json")
    back = b.spark.read.schema("branch string, Hour int, StoreName string, Transactions bigint, TotalSales double").json(path)
    back = positions(with_places(back), ["branch"])
    return back.select("branch", "position", "Hour", "StoreName")


def sealed_invoices(b: Bundle) -> DataFrame:
    """The invoices sealed row by row, written, read back and unsealed."""
    plain = ledger.ledger_invoices(b["ledger_invoices"])
    key = b.spark.range(1).select(F.unhex(F.sha2(F.lit("possum check key"), 256)).alias("key")).select("key").scalar()
    path = os.path.join(out_folder(b, "sealed"), "ledger_invoices")
    seal(plain, key, [c for c in plain.columns if c != "branch"], keep=["branch"]).write.json(path)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields if f.name != "branch")
    envelope = "branch string, v int, salt string, iv string, ct string"
    return unseal(b.spark.read.schema(envelope).json(path), key, kinds, keep=["branch"])


def _write_feed(feed: DataFrame, path: str) -> None:
    """The feed as JSON files of unknown keys."""
    entry = F.to_json(F.struct(F.col("net").cast("string").alias("net"), F.lit(True).alias("closed")))
    text = F.concat(F.lit('{"sessionOk": false, "days": {'), F.array_join(F.collect_list(
        F.concat(F.lit('"'), "day_key", F.lit('": '), entry)), ", "), F.lit("}}"))
    # one file per month of the feed
    feed.groupBy(F.substring("day_key", 4, 7).alias("m")).agg(text.alias("value")).repartition("m") \
        .write.partitionBy("m").mode("append").text(path)


def feed_from_json(b: Bundle) -> DataFrame:
    """The feed written as JSON files of unknown keys, read back and re-keyed."""
    path = os.path.join(out_folder(b, "feed"), "files")
    _write_feed(b["net_feed"], path)
    got = assemble.net_feed_days(read_feed(b.spark, path))
    return got.select("day", out(F.col("net")).alias("net"), F.col("session_ok"))


def followed_feed(b: Bundle) -> DataFrame:
    """D24 as files arrive: provisional amounts first, then the files that correct them."""
    root = out_folder(b, "followed-feed")
    files, days, state = (os.path.join(root, x) for x in ("files", "days", "state"))
    for feed in (b["net_feed"].withColumn("net", F.col("net") + 1), b["net_feed"]):
        _write_feed(feed, files)
        start_feed(b.spark, files, days, state).awaitTermination()
    return read_days(b.spark, days).select("day", out(F.col("net")).alias("net"), "session_ok")


def optional_presence(b: Bundle) -> DataFrame:
    """The attendance of a stored bundle, and of one whose presence table is absent (no rows)."""
    root = out_folder(b, "optional")
    names = ("store", "presence_view")
    write_bundle(Bundle({n: b[n] for n in names}, b.branches), os.path.join(root, "full"))
    write_bundle(Bundle({"store": b["store"]}, b.branches), os.path.join(root, "without"))
    parts = []
    for kind in ("full", "without"):
        tables = {"store": b.spark.read.parquet(os.path.join(root, kind, "store")),
                  "presence_view": optional_table(b.spark, "presence_view", lambda k=kind: b.spark.read.parquet(
                      os.path.join(root, k, "presence_view")))}
        if "branch" not in tables["presence_view"].columns:
            tables["presence_view"] = tables["presence_view"].withColumn("branch", F.lit("main"))
        got = attendance.attendance(Bundle(tables, b.branches), RULES, AS_OF_PEOPLE)
        parts.append(got.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n")))
    return parts[0].unionByName(parts[1])


def net_days(b: Bundle) -> DataFrame:
    return assemble.net_feed_days(b["net_feed"])


ON_BUNDLE: dict[str, Callable[[Bundle], DataFrame]] = {
    # stock job
    "stock_summary": lambda b: stock.finish_stock_summary(stock.stock_summary(b, RULES)),
    "low_stock": lambda b: stock.low_stock(b, RULES),
    "stock_by_department": lambda b: stock.finish_stock_by_department(
        stock.stock_by_department(b, RULES)),
    "stock_lines": stock_lines_out,
    "item_catalogue": lambda b: stock.flatten_catalogue(catalogue(b)),
    "impute_cost": lambda b: items_flat(imputed(b)),
    "apply_price_list": lambda b: items_flat(priced(b)),
    "revalue_stock": lambda b: stock.finish_stock_summary(revalued(b)[0]),
    "revalue_stock_by_department": lambda b: stock.finish_stock_by_department(revalued(b)[1]),
    "monthly_sales": lambda b: sales.monthly_sales(b, RULES, AS_OF),
    "stock_report": lambda b: stock.flatten_stock_report(stock.stock_report(b, RULES)),
    # daily job
    "sales_by_store_day": lambda b: sales.amounts_out(sales.sales_by_store_day(b, RULES)),
    "sales_by_department_day": lambda b: sales.amounts_out(sales.sales_by_department_day(b, RULES)),
    "sales_by_seller_day": lambda b: sales.amounts_out(sales.sales_by_seller_day(b, RULES)),
    "sales_daily": lambda b: sales.amounts_out(sales.daily_from_stores(sales.sales_by_store_day(b, RULES))),
    "sales_by_hour": lambda b: sales.sales_by_hour(b, RULES, AS_OF),
    "today_total": lambda b: sales.amounts_out(sales.today_total_from_sales(b, RULES, AS_OF)),
    "payments_by_day": lambda b: sales.amounts_out(payments.payments_by_day(b, RULES)),
    "ledger_monthly": lambda b: ledger.ledger_monthly(b["ledger_monthly"]),
    "ledger_invoices": lambda b: ledger.ledger_invoices(b["ledger_invoices"]),
    "supplier_monthly": lambda b: suppliers.supplier_monthly(b, RULES, AS_OF),
    "supplier_documents": lambda b: suppliers.supplier_documents(b, RULES, AS_OF),
    "attendance": lambda b: attendance.flatten_attendance(attendance.attendance(b, RULES, AS_OF_PEOPLE)),
    "promotion_redemptions": lambda b: promotions.finish_redemptions(
        promotions.promotion_redemptions(b, RULES, AS_OF)),
    "promotion_matrix": lambda b: promotions.flatten_promotion_matrix(promotions.promotion_matrix(
        promotions.promotion_redemptions(b, RULES, AS_OF), b, RULES)),
    "day_documents": lambda b: assemble.flatten_day_documents(day_docs(b)),
    "net_feed_days": lambda b: net_days(b).select("day", out(F.col("net")).alias("net")),
    "net_feed_today": lambda b: assemble.net_feed_today(net_days(b), AS_OF_PEOPLE).select(
        "day", out(F.col("net")).alias("net")),
    "user_directory": lambda b: people.user_directory(b, RULES),
    # under change, skew and long lists
    "changed_days": changed_days,
    "salted_department_day": lambda b: sales.amounts_out(sales.sales_by_department_day(b, RULES, heavy_lines(b))),
    "salted_redemptions": lambda b: promotions.finish_redemptions(promotions.promotion_redemptions(b, RULES, AS_OF, heavy_lines(b))),
    "long_price_list": lambda b: items_flat(pricing.apply_long_price_list(catalogue(b), long_price_list(b))),
    "merged_supplier_months": merged_supplier_months,
    "refilled_cost": refilled_cost,
    # written and read back
    "daily_bundle": daily_bundle,
    "written_order": written_order,
    "sealed_invoices": sealed_invoices,
    "feed_from_json": feed_from_json,
    "followed_feed": followed_feed,
    "optional_presence": optional_presence,
}

# written and read back; the bench times the jobs instead
WRITTEN = ("changed_days", "daily_bundle", "written_order", "sealed_invoices", "feed_from_json", "followed_feed", "optional_presence")

# datasets over two branches (A: even stores; B: odd stores, labelled)
ON_PARTS: dict[str, Callable[[Parts], DataFrame]] = {
    "union_branches": branch_sales,
    "monthly_sales_two_branches": branch_monthly_sales,
    "relabel_branch": relabelled_catalogue,
    "merge_sum": merged_sellers,
    "dedupe_first": deduped_users,
}


def on_bundle(name: str, bundle: Bundle) -> DataFrame:
    """Dataset ``name`` over a canonical single-branch bundle."""
    if name in ON_BUNDLE:
        return ON_BUNDLE[name](bundle)
    return ON_PARTS[name](split_branches(bundle, LABEL_B))


# facts that a dataset reads several times: joined up once
STORED = {"changed_days": retract.CHANGE_TABLES}


def _fixture(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        put = Stage(spark, f"{name}-input").put if name in STORED else None
        return on_bundle(name, fixture_bundle(spark, sf_dir, stored=STORED.get(name, ()), put=put))
    run.__name__ = name
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _fixture(name) for name in [*ON_BUNDLE, *ON_PARTS]}
