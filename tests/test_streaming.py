"""The incremental refresh equals the full computation on the touched months."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from possum_checks.params import AS_OF, RULES
from possum.functions.dates import month_label
from possum.operators import sales
from possum.plans.daily_job import run_daily_job
from possum.plans.publish import read_published
from possum.sources.parquet import read_bundle, write_bundle
from possum.sources.sinks import decimals_to_double
from possum.streaming.refresh import DAY_DATASETS, start_refresh, touched_months


def _read(spark, path):
    return read_published(spark, *os.path.split(path)).drop("SaleMonth")


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_refresh_touched_months_only(spark, fixture_bundle):
    root = tempfile.mkdtemp(prefix="possum-refresh-")
    canon = os.path.join(root, "canonical")
    write_bundle(fixture_bundle, canon)
    bundle = read_bundle(spark, canon)
    t = bundle["pos_transaction"].withColumn("d", month_label(F.col("SaleTime")))
    months = [r.d for r in t.select("d").distinct().orderBy("d").limit(2).collect()]
    changes = os.path.join(root, "changes")
    out = os.path.join(root, "out")
    ckpt = os.path.join(root, "stream-ckpt")

    # first run: changes in month 0
    t.where(F.col("d") == months[0]).drop("d", "branch").write.parquet(os.path.join(changes, "b1"))
    q = start_refresh(spark, os.path.join(changes, "*"), lambda: read_bundle(spark, canon), RULES, out, ckpt)
    q.awaitTermination(300)
    assert q.exception() is None
    got = _read(spark, os.path.join(out, "stores"))
    assert {r.SaleDate[:7] for r in got.select("SaleDate").distinct().collect()} == {months[0]}

    # second run: a new file touching month 1; month 0 stays
    t.where(F.col("d") == months[1]).drop("d", "branch").write.parquet(os.path.join(changes, "b2"))
    q = start_refresh(spark, os.path.join(changes, "*"), lambda: read_bundle(spark, canon), RULES, out, ckpt)
    q.awaitTermination(300)
    assert q.exception() is None
    for name, build in DAY_DATASETS.items():
        full = decimals_to_double(build(bundle, RULES)).where(F.substring("SaleDate", 1, 7).isin(months))
        inc = _read(spark, os.path.join(out, name))
        cols = sorted(full.columns)
        assert _rows(inc, cols) == _rows(full, cols), name
    daily = _read(spark, os.path.join(out, "daily"))
    full_daily = decimals_to_double(sales.sales_daily(bundle, RULES)).where(F.substring("SaleDate", 1, 7).isin(months))
    assert _rows(daily, sorted(full_daily.columns)) == _rows(full_daily, sorted(full_daily.columns))
    docs = _read(spark, os.path.join(out, "by_date"))
    full_days = sales.sales_daily(bundle, RULES).where(F.substring("SaleDate", 1, 7).isin(months))
    assert docs.count() >= full_days.count() > 0


def test_changed_lines_refresh_their_transactions_month(spark, fixture_bundle):
    root = tempfile.mkdtemp(prefix="possum-refresh-lines-")
    canon = os.path.join(root, "canonical")
    write_bundle(fixture_bundle, canon)
    bundle = read_bundle(spark, canon)
    t = bundle["pos_transaction"].withColumn("m", month_label(F.col("SaleTime")))
    month = t.select("m").distinct().orderBy(F.desc("m")).first().m
    ids = t.where(F.col("m") == month).select("TransactionID")
    lines = bundle["transaction_entry"].join(ids, "TransactionID", "left_semi").drop("branch")
    feeds = {"pos_transaction": os.path.join(root, "t"), "transaction_entry": os.path.join(root, "te")}
    t.limit(0).drop("m", "branch").write.parquet(feeds["pos_transaction"])   # no transaction changed
    lines.write.parquet(feeds["transaction_entry"])
    out = os.path.join(root, "out")
    q = start_refresh(spark, feeds, lambda: read_bundle(spark, canon), RULES, out, os.path.join(root, "ck"))
    q.awaitTermination(300)
    assert q.exception() is None
    got = _read(spark, os.path.join(out, "depts"))
    assert {r.SaleDate[:7] for r in got.select("SaleDate").distinct().collect()} == {month}
    full = decimals_to_double(DAY_DATASETS["depts"](bundle, RULES)).where(F.substring("SaleDate", 1, 7) == month)
    assert _rows(got, sorted(full.columns)) == _rows(full, sorted(full.columns))


def _refresh(spark, canon, feeds, out, root, fmt="json"):
    q = start_refresh(spark, feeds, lambda: read_bundle(spark, canon), RULES, out, tempfile.mkdtemp(dir=root), fmt=fmt)
    q.awaitTermination(300)
    assert q.exception() is None


def test_voided_and_moved_transactions(spark, fixture_bundle):
    """A month whose transactions are all voided loses its folder; a moved transaction
    refreshes the month it left."""
    root = tempfile.mkdtemp(prefix="possum-refresh-void-")
    out = os.path.join(root, "out")
    bundle = fixture_bundle
    t = bundle["pos_transaction"].withColumn("m", month_label(F.col("SaleTime")))
    months = [r.m for r in t.where("Status > -1").select("m").distinct().orderBy("m").limit(3).collect()]
    canon = os.path.join(root, "canonical")
    write_bundle(bundle, canon)
    feed = os.path.join(root, "all")
    t.where(F.col("m").isin(months)).drop("m").write.parquet(feed)
    _refresh(spark, canon, feed, out, root)
    assert {r.SaleMonth for r in read_published(spark, out, "stores").select("SaleMonth").distinct().collect()} == set(months)
    # month 0 voided; one transaction of month 1 moves to month 2
    moved = t.where((F.col("m") == months[1]) & (F.col("Status") > -1)).orderBy("TransactionID").first()
    to = t.where(F.col("m") == months[2]).orderBy("TransactionID").first().SaleTime
    new = (t.withColumn("SaleTimeBefore", F.col("SaleTime"))
           .withColumn("Status", F.when(F.col("m") == months[0], -1).otherwise(F.col("Status")))
           .withColumn("SaleTime", F.when(F.col("TransactionID") == moved.TransactionID, F.lit(to)).otherwise(F.col("SaleTime"))))
    canon2 = os.path.join(root, "canonical2")
    write_bundle(bundle.with_tables(pos_transaction=new.drop("m", "SaleTimeBefore")), canon2)
    feed2 = os.path.join(root, "changed")
    new.where((F.col("m") == months[0]) | (F.col("TransactionID") == moved.TransactionID)).drop("m").write.parquet(feed2)
    _refresh(spark, canon2, feed2, out, root)
    for name, build in DAY_DATASETS.items():
        full = build(read_bundle(spark, canon2), RULES).where(F.substring("SaleDate", 1, 7).isin(months))
        got = _read(spark, os.path.join(out, name))
        assert _rows(got, sorted(full.columns)) == _rows(decimals_to_double(full), sorted(full.columns)), name
    assert {r.SaleMonth for r in read_published(spark, out, "stores").select("SaleMonth").distinct().collect()} == set(months[1:])


def test_format_passes_through_and_the_published_run_is_refreshed(spark, fixture_bundle):
    root = tempfile.mkdtemp(prefix="possum-refresh-fmt-")
    out, canon, feed = (os.path.join(root, n) for n in ("out", "canonical", "feed"))
    write_bundle(fixture_bundle, canon)
    run_daily_job(fixture_bundle, RULES, AS_OF, out, fmt="parquet")
    t = fixture_bundle["pos_transaction"]
    t.where(F.date_format("SaleTime", "yyyy-MM") == "2001-07").write.parquet(feed)
    before = _rows(read_published(spark, out, "stores", "parquet"), ["SaleDate", "StoreName", "TotalSales"])
    _refresh(spark, canon, feed, out, root, "parquet")
    folders = [d for d in os.listdir(out) if d.startswith("refresh-")]
    assert len(folders) == 1 and os.listdir(os.path.join(out, folders[0], "stores", "SaleMonth=2001-07"))
    files = [f for d, _, fs in os.walk(os.path.join(out, folders[0])) for f in fs if not f.startswith((".", "_"))]
    assert files and all(f.endswith(".parquet") for f in files)
    assert _rows(read_published(spark, out, "stores", "parquet"), ["SaleDate", "StoreName", "TotalSales"]) == before


def test_ids_are_matched_within_their_branch(spark, fixture_bundle):
    from possum.operators.branches import union_branches
    from possum.sources.adapters import split_branches
    a, b = split_branches(fixture_bundle, None)
    shifted = b[0]["pos_transaction"].withColumn("SaleTime", F.col("SaleTime") + F.expr("INTERVAL 10 YEAR"))
    u = union_branches([a, (b[0].with_tables(pos_transaction=shifted), None)])
    one = a[0]["pos_transaction"].orderBy("TransactionID").first()
    row = [("A", one.TransactionID, None, None), ("A", None, None, None)]
    changes = spark.createDataFrame(row, "branch string, TransactionID bigint, SaleTime timestamp_ntz, SaleTimeBefore timestamp_ntz")
    assert touched_months(changes, u) == [one.SaleTime.strftime("%Y-%m")]
    both = changes.withColumn("branch", F.lit(None).cast("string"))
    assert len(touched_months(both, u)) == 2
