"""Several branches: merges equal the single-database result; labels and
per-branch limits hold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from possum_checks.params import AS_OF, PRICE_LIST, RULES
from possum.bundle import Branch
from possum.operators import branches, payments, promotions, sales, suppliers
from possum.plans.stock_job import build_stock
from possum.sources.adapters import split_branches
from possum.sources.parquet import read_bundle, write_bundle


def _rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("build", [sales.sales_by_store_day, sales.sales_by_department_day,
                                   sales.sales_by_seller_day, sales.sales_daily, payments.payments_by_day])
def test_merged_branches_equal_one_database(fixture_bundle, build):
    # every transaction lands in exactly one branch (its store's), so
    # aggregating per branch and merging gives the single-database answer
    union = branches.union_branches(split_branches(fixture_bundle, None))
    assert _rows(build(union, RULES)) == _rows(build(fixture_bundle, RULES))


def test_stock_job_over_labelled_branches(fixture_bundle):
    union = branches.union_branches(split_branches(fixture_bundle, "Branch B"))
    out = build_stock(union, RULES, AS_OF, PRICE_LIST)
    s = out["search_items"]
    b_maps = [r.s for r in s.where(F.col("branch") == "B").collect()]
    assert b_maps and all(list(m) == ["Branch B"] for m in b_maps)
    a_stores = {k for r in s.where(F.col("branch") == "A").collect() for k in r.s}
    assert a_stores and all(int(k.split("_")[1]) % 2 == 0 for k in a_stores)
    # labels apply to the shown store name; each branch keeps its own rows
    names = {(r.branch, r.StoreName) for r in out["store_summary"].collect()}
    assert {n for b, n in names if b == "B"} == {"Branch B"}
    low = out["low_stock"].groupBy("branch").agg(F.count(F.lit(1)).alias("n"), F.max("Rank").alias("m"))
    for r in low.collect():
        assert r.n == r.m <= RULES.low_stock_limit
    # the user list keeps one row per (user, hash): the first branch wins
    users = out["users_list"]
    assert users.count() == users.select("user", "hash").distinct().count()
    assert {r.branch for r in users.collect()} == {"A"}


def test_daily_totals_from_store_rows(fixture_bundle):
    stores = sales.sales_by_store_day(fixture_bundle, RULES)
    assert _rows(sales.daily_from_stores(stores)) == _rows(sales.sales_daily(fixture_bundle, RULES))


def test_written_order_follows_branch_configuration(spark, fixture_bundle):
    import json
    import os
    import tempfile
    from possum.plans.stock_job import run_stock_job
    a, b = split_branches(fixture_bundle, None)
    union = branches.union_branches([b, a])            # B configured first
    out = tempfile.mkdtemp(prefix="possum-branch-order-")
    paths = run_stock_job(union, RULES, AS_OF, out, PRICE_LIST)
    rows = [json.loads(ln) for f in sorted(os.listdir(paths["low_stock"])) if f.endswith(".json")
            for ln in open(os.path.join(paths["low_stock"], f)) if ln.strip()]
    seq = [(r["branch"], r["Rank"]) for r in rows]
    assert seq == sorted(seq, key=lambda x: (x[0] != "B", x[1])) and {x[0] for x in seq} == {"A", "B"}


def test_stored_multi_branch_bundle_keeps_every_branch(spark, fixture_bundle):
    import tempfile
    from possum.operators import people
    from possum.sources.parquet import read_bundle, write_bundle
    from possum.bundle import Branch
    union = branches.union_branches(split_branches(fixture_bundle, "Branch B"))
    root = tempfile.mkdtemp(prefix="possum-stored-")
    write_bundle(union, root)
    want = _rows(people.user_directory(union, RULES))
    configured = read_bundle(spark, root, (Branch("A"), Branch("B", "Branch B")))
    assert _rows(people.user_directory(configured, RULES)) == want
    # read without the branch list: no row is lost (labels are unknown then)
    bare = people.user_directory(read_bundle(spark, root), RULES)
    assert bare.count() == len(want)
    assert {r.branch for r in bare.collect()} == {"A", "B"}


@pytest.mark.parametrize("build", [
    lambda b: sales.monthly_sales(b, RULES, AS_OF),
    lambda b: suppliers.supplier_monthly(b, RULES, AS_OF),
    lambda b: suppliers.supplier_documents(b, RULES, AS_OF),
    lambda b: promotions.promotion_redemptions(b, RULES, AS_OF),
    lambda b: promotions.flatten_promotion_matrix(
        promotions.promotion_matrix(promotions.promotion_redemptions(b, RULES, AS_OF), b, RULES))],
    ids=["D9", "D17", "D18", "D21", "D22"])
def test_rows_do_not_depend_on_the_configured_branches(stored_pair, build):
    spark, root, union = stored_pair
    want = _rows(build(union))
    assert want
    for configured in ((Branch("A"), Branch("B", "Branch B")), (Branch("A"),), (Branch("main"),)):
        assert _rows(build(read_bundle(spark, root, configured))) == want


@pytest.fixture(scope="module")
def stored_pair(spark, fixture_bundle):
    import tempfile
    union = branches.union_branches(split_branches(fixture_bundle, "Branch B"))
    root = tempfile.mkdtemp(prefix="possum-pair-")
    write_bundle(union, root)
    return spark, root, union
