"""Command line for the two jobs (the reference's two scripts).

    python -m possum.plans.run daily --config job.json --as-of 2024-01-30T12:00 --out /shared/daily
    python -m possum.plans.run stock --canonical /shared/canonical --out /shared/stock
    python -m possum.plans.run refresh --canonical /shared/canonical --out /shared/daily \
        --changes pos_transaction=/shared/cdc/transactions --stream-checkpoint /shared/ckpt/refresh

(or ``spark-submit --py-files possum.zip possum/plans/run.py ...`` on a cluster)

``job.json``::

    {"branches": [{"name": "main", "url": "jdbc:sqlserver://host;databaseName=pos",
                   "user": "reader", "password_env": "POS_MAIN_PASSWORD",
                   "label": null, "missing": ["ledger_monthly", "ledger_invoices"]}],
     "rules": {"general_department": "General"},
     "price_list": [["small widget", "11.50"]],
     "partitions": 64}

Passwords are read from the environment variable each branch names. With
``--canonical`` the tables are read from a Parquet bundle instead, with
``--tables`` from catalog tables (e.g. the bucketed layout of
``possum.sources.tables``).
"""

from __future__ import annotations

import argparse
import json
import os
from dataclasses import fields
from datetime import datetime

from pyspark.sql import SparkSession

from possum.bundle import Branch, Bundle
from possum.operators.branches import union_branches
from possum.plans.daily_job import run_daily_job
from possum.plans.stock_job import run_stock_job
from possum.rules import Rules
from possum.sources.jdbc import JdbcBranch, read_branch
from possum.sources.parquet import read_bundle
from possum.sources.tables import read_bundle_tables
from possum.streaming.refresh import start_refresh


def load_rules(overrides: dict) -> Rules:
    known = {f.name: f for f in fields(Rules)}
    unknown = set(overrides) - set(known)
    if unknown:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    base = Rules()
    args = {}
    for k, v in overrides.items():
        default = getattr(base, k)
        args[k] = tuple(tuple(x) if isinstance(x, list) else x for x in v) if isinstance(default, tuple) else v
    return Rules(**args)


def _branches(config: dict) -> tuple[Branch, ...]:
    """Branch names and labels in configured order (for stored bundles)."""
    return tuple(Branch(b["name"], b.get("label")) for b in config.get("branches", [])) or (Branch("main"),)


def load_bundle(spark: SparkSession, config: dict, canonical: str | None,
                database: str | None = None) -> Bundle:
    if canonical:
        return read_bundle(spark, canonical, _branches(config))
    if database:
        return read_bundle_tables(spark, database, _branches(config))
    parts = []
    for b in config["branches"]:
        env = b.get("password_env")
        src = JdbcBranch(b["name"], b["url"], b.get("user"), os.environ.get(env) if env else None,
                         b.get("label"))
        parts.append((read_branch(spark, src, config.get("partitions", 64), tuple(b.get("missing", ()))),
                      b.get("label")))
    return union_branches(parts)


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="possum.plans.run")
    p.add_argument("job", choices=["stock", "daily", "refresh"])
    p.add_argument("--config", help="JSON job configuration")
    p.add_argument("--canonical", help="read canonical tables from this Parquet bundle")
    p.add_argument("--tables", help="read canonical tables from this catalog database")
    p.add_argument("--as-of", default=None, help="ISO timestamp; default: now")
    p.add_argument("--out", required=True)
    p.add_argument("--feed", default=None, help="folder of net-amount feed files (daily job)")
    p.add_argument("--format", default="json", choices=["json", "parquet"])
    p.add_argument("--changes", action="append", default=[],
                   help="refresh: table=folder of change files (repeatable)")
    p.add_argument("--stream-checkpoint", help="refresh: shared folder for the stream's progress")
    a = p.parse_args(argv)
    if not (a.config or a.canonical or a.tables):
        p.error("give --config, --canonical or --tables")
    if a.job == "refresh" and (not a.changes or not a.stream_checkpoint):
        p.error("refresh needs --changes and --stream-checkpoint")
    return a


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    a = parse(argv)
    config = json.load(open(a.config)) if a.config else {}
    spark = spark or SparkSession.builder.appName(f"possum-{a.job}").getOrCreate()
    rules = load_rules(config.get("rules", {}))
    as_of = datetime.fromisoformat(a.as_of) if a.as_of else datetime.now().replace(microsecond=0)
    bundle = load_bundle(spark, config, a.canonical, a.tables)
    if a.job == "stock":
        price_list = [tuple(x) for x in config.get("price_list", [])]
        return run_stock_job(bundle, rules, as_of, a.out, price_list, fmt=a.format)
    if a.job == "refresh":
        feeds = dict(c.split("=", 1) for c in a.changes)
        q = start_refresh(spark, feeds, lambda: load_bundle(spark, config, a.canonical, a.tables), rules,
                          a.out, a.stream_checkpoint, fmt=a.format)
        q.awaitTermination()
        return {"refresh": a.out}
    return run_daily_job(bundle, rules, as_of, a.out, feed_path=a.feed, fmt=a.format)


if __name__ == "__main__":
    main()
