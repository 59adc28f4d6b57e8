"""The stock and sales job: D1-D9c for a bundle of branches, one dataset
folder each.

Plan shape: the stock base (item-store x item x store) is built once and
staged; D1-D4 and D9b read the staged copy. The priced item catalogue
(D5 -> D6 -> D7) is staged twice: the catalogue before imputation reads it
three times (known costs, items to fill, the rest), and the priced items
feed both D8 and the search output. Everything else is one lazy plan per
dataset.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.operators import branches, people, pricing, sales, stock
from possum.operators.base import stock_base
from possum.plans.common import Stage, write_ordered
from possum.plans.publish import Manifest, commit, expire, read_manifest
from possum.rules import Rules


def build_stock(bundle: Bundle, rules: Rules, as_of: datetime,
                price_list: Sequence[tuple[str, str]] = (), stage: Stage | None = None) -> dict[str, DataFrame]:
    put = stage.put if stage is not None else (lambda _name, df: df)
    base = put("stock_base", stock_base(bundle, rules))
    summary = stock.stock_summary(bundle, rules, base=base)
    # the reference lists departments by their value before revaluation
    by_dept = stock.stock_by_department(bundle, rules, base=base).withColumn("SortValue", F.col("Value"))
    items = put("catalogue", stock.item_catalogue(stock.stock_lines(bundle, rules, base=base)))
    items = put("items", pricing.apply_price_list(pricing.impute_cost(items), price_list))
    summary, by_dept = pricing.revalue_stock(summary, by_dept, items, rules)
    report = stock.stock_report(bundle, rules, base=base)
    users = people.dedupe_first(people.user_directory(bundle, rules), bundle, ["user", "hash"], ["no"])
    return {
        "store_summary": stock.finish_stock_summary(summary),
        "low_stock": stock.low_stock(bundle, rules, base=base),
        "by_department": stock.finish_stock_by_department(by_dept, extra=("SortValue",)),
        "search_items": stock.finish_catalogue(branches.relabel_branch(items, bundle)),
        "report_items": stock.finish_stock_report(branches.relabel_branch(report, bundle)),
        "sales_items": sales.monthly_sales(bundle, rules, as_of),
        "users_list": users,
    }


# the order of each dataset in the reference's output (sink only)
ORDER = {
    "store_summary": ["branch", "Sort"],
    "low_stock": ["branch", "Rank"],
    "by_department": ["branch", "-SortValue"],
    "users_list": ["branch", "no"],
}


# helper columns (sort keys, merge keys) not in the reference's output records
DROP = {"store_summary": ("Sort",), "by_department": ("SortValue",), "search_items": ("key",)}


def run_stock_job(bundle: Bundle, rules: Rules, as_of: datetime, out_dir: str,
                  price_list: Sequence[tuple[str, str]] = (), fmt: str = "json", keep: int = 2) -> dict[str, str]:
    """Build and write every dataset into a folder of this run, then publish it
    (:mod:`possum.plans.publish`): a run that fails half-way changes nothing that
    readers see. The last ``keep`` versions stay. Returns dataset -> folder."""
    spark = bundle.spark
    stage = Stage(spark, "stock_job")
    run_dir = os.path.join(out_dir, f"run-{uuid.uuid4().hex}")
    paths = {}
    for name, df in build_stock(bundle, rules, as_of, price_list, stage).items():
        path = os.path.join(run_dir, name)
        write_ordered(bundle, df, path, ORDER.get(name, ()), fmt, drop=DROP.get(name, ()))
        paths[name] = path
    last = read_manifest(spark, out_dir)
    commit(spark, out_dir, Manifest(last.version if last else 0, run_dir, tuple(sorted(paths)),
                                    last_updated=as_of.strftime("%d/%m/%Y %H:%M")))
    stage.drop()
    expire(spark, out_dir, keep)
    return paths
