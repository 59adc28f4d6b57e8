"""The two job plans end to end, the sinks and the JDBC option builder."""

from __future__ import annotations

import base64
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from possum_checks.params import AS_OF, PRICE_LIST, RULES
from possum_checks.queries import QUERIES
from possum.plans.daily_job import published, run_daily_job
from possum.plans.stock_job import run_stock_job
from possum.sources.jdbc import JdbcBranch, jdbc_options
from possum.sources.sinks import seal, unseal

from conftest import SF_SMALL


def test_stock_job_writes_every_dataset(spark, fixture_bundle):
    out = tempfile.mkdtemp(prefix="possum-stock-")
    paths = run_stock_job(fixture_bundle, RULES, AS_OF, out, PRICE_LIST)
    assert set(paths) == {"store_summary", "low_stock", "by_department", "search_items", "report_items",
                          "sales_items", "users_list"}
    assert spark.read.json(paths["store_summary"]).count() == QUERIES["revalue_stock"](spark, SF_SMALL).count()
    assert spark.read.json(paths["sales_items"]).count() == QUERIES["monthly_sales"](spark, SF_SMALL).count()
    s = spark.read.json(paths["search_items"])
    assert dict(s.dtypes)["p"] == "double"
    m = spark.read.json(os.path.join(out, "_manifest")).first()
    assert m.last_updated == "01/08/2001 12:00" and "store_summary" in m.datasets


def test_daily_job_writes_every_dataset_and_manifest(spark, fixture_bundle):
    out = tempfile.mkdtemp(prefix="possum-daily-")
    feed = tempfile.mkdtemp(prefix="possum-feed-")
    with open(os.path.join(feed, "f.json"), "w") as f:
        json.dump({"days": {"1/8/2001": 7}}, f)
    paths = run_daily_job(fixture_bundle, RULES, AS_OF, out, feed_path=feed)
    assert spark.read.json(paths["daily"]).count() == QUERIES["sales_daily"](spark, SF_SMALL).count()
    m = spark.read.json(os.path.join(out, "_manifest")).first()
    assert m.today == "2001-08-01" and m.synced == "01/08/2001 12:00" and "by_date" in m.datasets
    assert spark.read.json(paths["net_feed_today"]).first().net == 7.0
    assert published(spark, out) == m.folder == os.path.dirname(paths["daily"])


def test_a_full_run_leaves_no_stale_month(spark, fixture_bundle):
    """A second run without a month does not show it, and the first run's folder is untouched."""
    out = tempfile.mkdtemp(prefix="possum-stale-")
    first = run_daily_job(fixture_bundle, RULES, AS_OF, out)
    t = fixture_bundle["pos_transaction"]
    gone = t.where("Status > -1").select(F.min(F.date_format("SaleTime", "yyyy-MM"))).first()[0]
    less = fixture_bundle.with_tables(pos_transaction=t.where(F.date_format("SaleTime", "yyyy-MM") != gone))
    run_daily_job(less, RULES, AS_OF, out)
    for name in ("stores", "depts", "sellers", "daily", "payments", "by_date"):
        now = spark.read.json(os.path.join(published(spark, out), name))
        assert now.where(F.col("SaleMonth") == gone).count() == 0
        assert spark.read.json(first[name]).where(F.col("SaleMonth") == gone).count() > 0


def test_static_overwrite_replaces_vanished_partitions(spark):
    from possum.sources.sinks import write_dataset
    path = os.path.join(tempfile.mkdtemp(prefix="possum-static-"), "d")
    two = spark.createDataFrame([("a", 1), ("b", 2)], "m string, x int")
    write_dataset(two, path, partition_by=["m"])
    write_dataset(two.where("m = 'a'"), path, partition_by=["m"], dynamic=True)
    assert spark.read.json(path).count() == 2
    write_dataset(two.where("m = 'a'"), path, partition_by=["m"])
    assert spark.read.json(path).count() == 1


def test_staged_folders_are_unique_and_removed(spark, fixture_bundle):
    from possum.plans.common import Stage
    from possum.session import checkpoint_dir
    assert Stage(spark, "x").root != Stage(spark, "x").root
    run_stock_job(fixture_bundle, RULES, AS_OF, tempfile.mkdtemp(prefix="possum-drop-"), PRICE_LIST)
    root = os.path.join(checkpoint_dir(spark), "possum-stage")
    assert not [d for d in os.listdir(root) if d.startswith("stock_job-")]


def test_seal_round_trip(spark):
    df = spark.createDataFrame([("d1", "A", 1.5), ("d1", "A", 1.5)], "k string, name string, v double")
    key = spark.createDataFrame([(bytes(range(32)),)], "key binary").select("key").scalar()
    sealed = seal(df, key, ["name", "v"], keep=["k"])
    path = os.path.join(tempfile.mkdtemp(prefix="possum-seal-"), "s")
    sealed.write.parquet(path)
    back = spark.read.parquet(path)
    rows = back.collect()
    assert rows[0].iv != rows[1].iv and rows[0].ct != rows[1].ct   # random IV per row
    assert all(len(base64.b64decode(r.salt)) == 18 for r in rows)
    again = seal(df, key, ["name", "v"], keep=["k"]).collect()
    assert base64.b64decode(again[0].salt)[:16] != base64.b64decode(rows[0].salt)[:16]   # keys of its own
    assert len(F.unbase64(F.lit(rows[0].iv)).__repr__()) > 0
    plain = unseal(back, key, "name string, v double", keep=["k"]).collect()
    assert sorted(map(tuple, plain)) == [("d1", "A", 1.5), ("d1", "A", 1.5)]


def test_jdbc_options():
    src = JdbcBranch("b1", "jdbc:sqlserver://db:1433;databaseName=pos", user="u", password="s3cr3t-pw")
    o = jdbc_options(src, "[Transaction]", "TransactionID", 1, 1000, 16)
    assert o["partitionColumn"] == "TransactionID" and o["numPartitions"] == "16"
    assert o["lowerBound"] == "1" and o["upperBound"] == "1000" and o["dbtable"] == "[Transaction]"
    assert "s3cr3t-pw" not in repr(src)
    assert "partitionColumn" not in jdbc_options(src, "Store")


def test_command_line_over_a_parquet_bundle(spark, fixture_bundle):
    from possum.plans.run import load_rules, main
    from possum.sources.parquet import write_bundle
    root = tempfile.mkdtemp(prefix="possum-cli-")
    write_bundle(fixture_bundle, os.path.join(root, "canonical"))
    cfg = os.path.join(root, "job.json")
    with open(cfg, "w") as f:
        json.dump({"rules": {"general_department": "PROMO", "general_name_token": "cold",
                             "barcode_deny": ["180", "240"]},
                   "price_list": [["small widget", "11.50"], ["widget", "12.25"]]}, f)
    paths = main(["stock", "--config", cfg, "--canonical", os.path.join(root, "canonical"),
                  "--as-of", "2001-08-01T12:00:00", "--out", os.path.join(root, "out")], spark=spark)
    assert spark.read.json(paths["store_summary"]).count() == QUERIES["revalue_stock"](spark, SF_SMALL).count()
    assert load_rules({"barcode_deny": ["1"]}).barcode_deny == ("1",)


def test_jdbc_branch_reader_against_embedded_derby(spark, fixture_bundle):
    """S1 end to end on an in-process database (Derby in memory: no server)."""
    from possum import schemas
    from possum.operators import sales
    from possum.sources.jdbc import SOURCE_TABLES, read_branch
    url = "jdbc:derby:memory:possum_pos;create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    names = {k: f"POS_{k.upper()}" for k in SOURCE_TABLES}
    needed = ("store", "pos_transaction", "users")
    for k in needed:
        df = fixture_bundle[k].drop("branch", "StoreNameOrig")
        df.write.mode("overwrite").option("driver", driver).jdbc(url, names[k])
    src = JdbcBranch("main", url, driver=driver, table_names=names)
    missing = tuple(k for k in SOURCE_TABLES if k not in needed)
    optional = tuple(k for k in missing if k in schemas.OPTIONAL)
    required = [k for k in missing if k not in schemas.OPTIONAL]
    for k in required:   # tables this check does not use: empty copies
        spark.createDataFrame([], schemas.schema(k)).write.mode("overwrite").option("driver", driver) \
            .jdbc(url, names[k])
    assert optional
    with pytest.warns(UserWarning, match="taken as empty"):   # absent optional tables, not listed as missing
        bundle = read_branch(spark, src, num_partitions=4)
    assert all(bundle[k].count() == 0 for k in optional)
    since = bundle["pos_transaction"].where(F.col("SaleTime") >= F.lit(AS_OF).cast("timestamp_ntz"))
    text = since._jdf.queryExecution().toString()
    assert "PushedFilters: [*IsNotNull(SaleTime), *GreaterThanOrEqual(SaleTime" in text
    got = sales.sales_by_seller_day(bundle, RULES)
    want = sales.sales_by_seller_day(fixture_bundle, RULES)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert bundle["pos_transaction"].rdd.getNumPartitions() == 4   # range-split read


def test_json_sink_contract(spark):
    from datetime import datetime
    from decimal import Decimal

    from possum.sources.sinks import write_dataset
    df = spark.createDataFrame(
        [(datetime(2024, 1, 2, 3, 4, 5), Decimal("12.50"), None, {"a": Decimal("1.5")})],
        "ts timestamp_ntz, amount decimal(18,2), note string, s map<string,decimal(18,1)>")
    path = os.path.join(tempfile.mkdtemp(prefix="possum-sink-"), "d")
    write_dataset(df, path)
    lines = [ln for f in sorted(os.listdir(path)) if f.endswith(".json")
             for ln in open(os.path.join(path, f), encoding="utf-8") if ln.strip()]
    assert [json.loads(ln) for ln in lines] == [
        {"ts": "2024-01-02 03:04", "amount": 12.5, "note": None, "s": {"a": 1.5}}]


def test_sink_order(spark, fixture_bundle):
    from possum.operators import stock
    from possum.sources.sinks import write_dataset
    path = os.path.join(tempfile.mkdtemp(prefix="possum-order-"), "low")
    df = stock.low_stock(fixture_bundle, RULES)
    write_dataset(df, path, order_by=[F.col("branch"), F.col("Rank")])
    ranks = [json.loads(ln)["Rank"] for f in sorted(os.listdir(path)) if f.endswith(".json")
             for ln in open(os.path.join(path, f)) if ln.strip()]
    assert ranks == sorted(ranks) and len(ranks) == df.count()


def test_daily_job_over_bucketed_tables(spark, fixture_bundle):
    from possum.plans.run import main
    from possum.sources.tables import save_bundle_tables
    save_bundle_tables(fixture_bundle, "possum_e2e", 4)
    out = os.path.join(tempfile.mkdtemp(prefix="possum-bucketed-"), "daily")
    paths = main(["daily", "--tables", "possum_e2e", "--as-of", "2001-08-01T12:00:00", "--out", out],
                 spark=spark)
    got = spark.read.json(paths["stores"]).drop("SaleMonth")
    want = QUERIES["sales_by_store_day"](spark, SF_SMALL)
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
