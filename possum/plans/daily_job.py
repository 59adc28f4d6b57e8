"""The daily job: D10-D21 over all branches, D22-D25, written as D26 (one
folder per dataset plus a one-row manifest; never one record holding all).

The four families of the date document (D10, D11, D12, D14) are staged once
and read back both for their own folders and for D23.
"""

from __future__ import annotations

import os
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.operators import assemble, attendance, ledger, payments, promotions, sales, suppliers
from possum.operators.base import MONTH
from possum.operators.daysums import DAY_SUMS, as_sums
from possum.plans.common import Stage, write_clustered, write_ordered
from possum.plans.publish import Manifest, commit, expire, read_manifest
from possum.rules import Rules
from possum.sources.feed import read_feed


def build_daily(bundle: Bundle, rules: Rules, as_of: datetime, feed_path: str | None = None,
                stage: Stage | None = None) -> dict[str, DataFrame]:
    put = stage.put if stage is not None else (lambda _name, df: df)
    stores = put("stores", sales.sales_by_store_day(bundle, rules))
    dept_sums = put("depts", sales.department_day_sums(bundle, rules))
    depts = dept_sums.drop("Lines")
    sellers = put("sellers", sales.sales_by_seller_day(bundle, rules))
    pays = put("payments", payments.payments_by_day(bundle, rules))
    redemptions = promotions.promotion_redemptions(bundle, rules, as_of)
    out = {
        "daily": sales.daily_from_stores(stores),
        "by_date": assemble.day_documents(stores, depts, sellers, pays),
        "stores": stores, "depts": depts, "sellers": sellers, "payments": pays,
        "ledger_monthly": ledger.ledger_monthly(bundle["ledger_monthly"]),
        "ledger_invoices": ledger.ledger_invoices(bundle["ledger_invoices"]),
        "sup_monthly": suppliers.supplier_monthly(bundle, rules, as_of),
        "sup_docs": suppliers.supplier_documents(bundle, rules, as_of),
        "hours_by_store": sales.sales_by_hour(bundle, rules, as_of),
        "presence": attendance.attendance(bundle, rules, as_of),
        "promos": promotions.promotion_matrix(redemptions, bundle, rules),
        "today_total": sales.today_total(stores, as_of),
    }
    # exact day sums: what a refresh by retraction adds to and takes from
    exact = {"stores": stores, "depts": dept_sums, "sellers": sellers, "payments": pays}
    out.update({f"_state/{name}": as_sums(name, exact[name]) for name in DAY_SUMS})
    if feed_path is not None:
        days = assemble.net_feed_days(read_feed(bundle.spark, feed_path))
        out["net_feed_days"] = days
        out["net_feed_today"] = assemble.net_feed_today(days, as_of)
    return out


# datasets keyed by the sale day: written as one folder per sale month, the
# layout the incremental refresh (possum.streaming.refresh) overwrites
DAY_KEYED = ("stores", "depts", "sellers", "daily", "payments", "by_date")


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.substring("SaleDate", 1, 7))


# the order of each dataset in the reference's output (sink only); the
# month-partitioned ones are sorted within each month folder
ORDER = {
    "daily": ["SaleDate"],
    "by_date": ["SaleDate"],
    "stores": ["SaleDate", "StoreName"],
    "depts": ["SaleDate", "-TotalSales"],
    "sellers": ["SaleDate", "-TotalSales"],
    "payments": ["SaleDate", "-TotalAmount"],
    "ledger_monthly": ["branch", "Year", "Month"],
    "ledger_invoices": ["branch", "-HenDate"],
    "sup_monthly": ["branch", "-YearMonth", "-TotalAmount"],
    "sup_docs": ["branch", "-DocDate"],
    "hours_by_store": ["branch", "Hour", "StoreName"],
    "presence": ["branch", "-iso"],
    "promos": ["-promo_total"],
}


# helper columns (merge and sort keys) not in the reference's output records
DROP = {"promos": ("key", "promo_total")}


def published(spark: SparkSession, out_dir: str, fmt: str = "json") -> str:
    """The folder of the full run that ``out_dir``'s manifest names, or ``out_dir``
    itself when no run has been published there. ``publish.read_published``
    reads a dataset with the months that refreshes have replaced since."""
    m = read_manifest(spark, out_dir)
    return out_dir if m is None else m.folder


def run_daily_job(bundle: Bundle, rules: Rules, as_of: datetime, out_dir: str,
                  feed_path: str | None = None, fmt: str = "json", keep: int = 2,
                  facts_rewritten: bool = False) -> dict[str, str]:
    """Build and write every dataset into a folder of this run, then publish it.

    Everything is written under ``out_dir/run-<id>`` first; the manifest (D26:
    today, synced, the datasets and their folder), committed last, names that
    folder, so readers that go by the manifest see the old run or the new one,
    never a mix. The last ``keep`` published versions stay, older run folders
    are removed. What refreshes know of lines stored under another month than
    their transaction's is kept, unless the facts were rewritten by month since
    (``facts_rewritten``). Returns dataset -> folder.
    """
    spark = bundle.spark
    stage = Stage(spark, "daily_job")
    run_dir = os.path.join(out_dir, f"run-{uuid.uuid4().hex}")
    paths = {}
    datasets = build_daily(bundle, rules, as_of, feed_path, stage)
    for name, df in datasets.items():
        path = os.path.join(run_dir, name)
        if name.startswith("_state/"):
            write_clustered(with_month(df), path, MONTH)
            continue
        if name in DAY_KEYED:
            write_ordered(bundle, with_month(df), path, ORDER.get(name, ()), fmt, partition_by=[MONTH])
        else:
            write_ordered(bundle, df, path, ORDER.get(name, ()), fmt, drop=DROP.get(name, ()))
        paths[name] = path
    last = read_manifest(spark, out_dir)
    known = last if last and not facts_rewritten else Manifest(0, run_dir)
    commit(spark, out_dir, Manifest(last.version if last else 0, run_dir, tuple(sorted(paths)), moved=known.moved, lines_of=known.lines_of,
                                    applied=last.applied if last else {}, today=as_of.strftime("%Y-%m-%d"),
                                    synced=as_of.strftime("%d/%m/%Y %H:%M")))
    stage.drop()
    expire(spark, out_dir, keep)
    return paths
