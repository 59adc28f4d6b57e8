"""Edge rows the generated data lacks (FIXTURES.md section 6)."""

from __future__ import annotations

import json
import os
import tempfile
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

import frames
from possum.functions import codes
from possum.functions.dates import day_key_to_iso, lookback
from possum.functions.money import cost_ladder, whole
from possum.functions.text import ustrip
from possum.operators import (assemble, attendance, branches, people, pricing, promotions, sales,
                              stock)
from possum.rules import Rules, TEST_RULES
from possum.sources.feed import read_feed
from possum.sources.optional import optional_table

R = Rules()


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_code_parse(spark):
    df = spark.createDataFrame([("25W0303M40",), ("180",), ("",), (None,), ("  25W0303M40\t",)], "b string")
    got = df.select(codes.model_code(F.col("b")).alias("mc"), codes.size_code(F.col("b")).alias("sz"),
                    codes.prefix_levels(F.col("b")).alias("lv")).collect()
    assert (got[0].mc, got[0].sz) == ("03", "M40")
    assert [(e.lvl, e.pre) for e in got[0].lv] == [(1, "25W0303"), (2, "W0303"), (3, "0303")]
    for r in got[1:4]:
        assert (r.mc, r.sz, r.lv) == ("", "", [])
    assert got[4].mc == "03"


def _items(spark, rows):
    return spark.createDataFrame(
        [("main", r["key"], r.get("n", r["key"]), r["b"], "", "", Decimal(str(r["p"])), {}, Decimal(1))
         for r in rows],
        "branch string, key string, n string, b string, mn string, d string, p decimal(18,2), "
        "s map<string,decimal(18,1)>, q decimal(18,1)")


def _p(df):
    return {r.key: float(r.p) for r in df.collect()}


def test_impute_prefix_case(spark):
    items = _items(spark, [{"key": "a", "b": "25w0303M1", "p": 5}, {"key": "b", "b": "25W0303M2", "p": 0}])
    assert _p(pricing.impute_cost(items))["b"] == 5.0  # level 1 and 2 miss (case), level 3 hits


def test_impute_level_order_and_no_cascade(spark):
    items = _items(spark, [
        {"key": "l1", "b": "25W0303M1", "p": 3},      # level-1 prefix 25W0303
        {"key": "l2", "b": "24W0303M1", "p": 9},      # level-2 prefix W0303 only
        {"key": "x", "b": "25W0303M9", "p": 0},       # level 1 = 3 wins over level 2 = 9
        {"key": "y", "b": "23S5555M1", "p": 0},       # nothing known
        {"key": "z", "b": "180", "p": 0},             # no code
        {"key": "w", "b": "", "p": 0}])
    got = _p(pricing.impute_cost(items))
    assert got["x"] == 3.0 and got["y"] == 0.0 and got["z"] == 0.0 and got["w"] == 0.0
    assert got["l1"] == 3.0 and got["l2"] == 9.0


def test_impute_never_changes_known_cost(spark):
    items = _items(spark, [{"key": "a", "b": "25W0303M1", "p": 7}, {"key": "b", "b": "25W0303M2", "p": 2}])
    assert _p(pricing.impute_cost(items)) == {"a": 7.0, "b": 2.0}


def test_price_list_first_entry_wins(spark):
    items = _items(spark, [{"key": "k", "n": "a b c", "b": "x", "p": 4}, {"key": "m", "n": "zzz", "b": "y", "p": 4}])
    got = _p(pricing.apply_price_list(items, [("a b", "7"), ("a", "9")]))
    assert got == {"k": 7.0, "m": 4.0}
    assert _p(pricing.apply_price_list(items, [])) == {"k": 4.0, "m": 4.0}


def test_cost_ladder(spark):
    df = spark.createDataFrame([(Decimal(0), None, Decimal(118)), (Decimal(0), Decimal(50), Decimal(118)),
                                (Decimal(0), Decimal(0), Decimal(0))],
                               "a decimal(18,2), b decimal(18,2), c decimal(18,2)")
    got = [r.p for r in df.select(cost_ladder(F.col("a"), F.col("b"), F.col("c"), Decimal("1.18")).alias("p")).collect()]
    assert got == [Decimal("100.00"), Decimal("50.00"), None]


def test_unicode_strip(spark):
    df = spark.createDataFrame([("\t x \n",), ("　y ",), (" a b ",)], "s string")
    assert [r.t for r in df.select(ustrip(F.col("s")).alias("t")).collect()] == ["x", "y", "a b"]


def _stock_bundle(spark, items, item_store, **extra):
    return frames.bundle(
        spark, store=[frames.STORE, {"StoreID": 2, "StoreName": "S2", "Code": "2", "Sort": 2, "Status": 1}],
        department=[{"DepartmentID": 1, "Name": "D"}], item_main=items, item_store=item_store, **extra)


def _item(i, name="item", barcode="25W0303M1", dept=1):
    return {"ItemID": i, "Name": name, "ModelNumber": "m", "BarcodeNumber": barcode, "DepartmentID1": dept,
            "Status": 1}


def _ist(i, store, qty, cost=10, rp=None):
    return {"ItemStoreID": i * 100 + store, "ItemID": i, "StoreID": store, "OnHand": qty, "Status": 1,
            "ReorderPoint": rp, "AVGCost": cost, "AVCostWithoutTax": 0, "CostWithoutTax": None}


def test_null_name_or_barcode_dropped(spark):
    b = _stock_bundle(spark, [_item(1, name=None), _item(2, barcode=None), _item(3)],
                      [_ist(1, 1, 5), _ist(2, 1, 5), _ist(3, 1, 5)])
    assert one(stock.stock_summary(b, R)).TotalSKUs == 1


def test_duplicate_barcode_store(spark):
    b = _stock_bundle(spark, [_item(1), _item(2)], [_ist(1, 1, 2), _ist(2, 1, 3)])
    row = one(stock.item_catalogue(stock.stock_lines(b, R)))
    assert {k: float(v) for k, v in row.s.items()} == {"S1": 3.0} and float(row.q) == 5.0


def test_catalogue_map_sums_to_total_when_unique(spark):
    b = _stock_bundle(spark, [_item(1)], [_ist(1, 1, 2), _ist(1, 2, 4)])
    row = one(stock.item_catalogue(stock.stock_lines(b, R)))
    assert sum(row.s.values()) == row.q == Decimal("6.0")


def test_group_pick_ties_and_inactive(spark):
    groups = [{"ItemGroupID": 1, "ItemGroupName": "G1", "Status": 1},
              {"ItemGroupID": 2, "ItemGroupName": "G2", "Status": 1},
              {"ItemGroupID": 3, "ItemGroupName": "G3", "Status": 0}]
    links = [{"ItemID": 1, "ItemGroupID": 2, "IsMainGroup": 1, "Status": 1},
             {"ItemID": 1, "ItemGroupID": 1, "IsMainGroup": 1, "Status": 1},   # tie: lowest id wins
             {"ItemID": 2, "ItemGroupID": 3, "IsMainGroup": 1, "Status": 1},   # inactive main group
             {"ItemID": 2, "ItemGroupID": 1, "IsMainGroup": 0, "Status": 1}]   # not promoted
    b = _stock_bundle(spark, [_item(1, name="one"), _item(2, name="two")], [_ist(1, 1, 1), _ist(2, 1, 1)],
                      item_group=groups, item_to_group=links)
    got = {r.n: r.g for r in stock.stock_report(b, R).collect()}
    assert got == {"one": "G1", "two": R.no_group}


def test_revaluation_zero_keeps_value(spark):
    b = _stock_bundle(spark, [_item(1, barcode="X1")], [_ist(1, 1, 3, cost=0)])
    summary, by_dept = pricing.revalue_stock(stock.stock_summary(b, R), stock.stock_by_department(b, R),
                                             stock.item_catalogue(stock.stock_lines(b, R)), R)
    assert one(summary).StockValue == 0


def test_rounding_half_even(spark):
    df = spark.createDataFrame([(Decimal("2.5"),), (Decimal("3.5"),)], "v decimal(18,1)")
    assert [int(r.w) for r in df.select(whole(F.col("v")).alias("w")).collect()] == [2, 4]


def _txn(tid, seller, total=10, store=1, ts="2024-01-01 10:00:00"):
    return {"TransactionID": tid, "StoreID": store, "SaleTime": ts, "Total": total, "TransactionType": 1,
            "SellerID": seller, "Status": 1}


def test_seller_names_unknown_merged(spark):
    users = [{"UserId": 1, "UserFName": None, "UserLName": "X", "Status": 1},
             {"UserId": 2, "UserFName": "X", "UserLName": None, "Status": 1},
             {"UserId": 3, "UserFName": "Ann ", "UserLName": "Lee ", "Status": 1}]
    b = frames.bundle(spark, store=[frames.STORE], users=users,
                      pos_transaction=[_txn(1, 1), _txn(2, 2), _txn(3, 3), _txn(4, None)])
    got = {r.SellerName: (r.TotalSales, r.Transactions) for r in sales.sales_by_seller_day(b, R).collect()}
    assert got == {R.unknown_seller: (30.0, 3), "Ann Lee": (10.0, 1)}


def test_punches(spark):
    pv = [{"UserID": 1, "Name": " a ", "UserNo": "1", "StoreID": 1, "PreDate": "2024-01-29",
           "Login1": "2024-01-29 22:00:00", "Logout1": "2024-01-30 06:30:00"},
          {"UserID": 2, "Name": "b", "UserNo": "2", "StoreID": 1, "PreDate": "2024-01-29",
           "Login1": "2024-01-29 08:00:00"},
          {"UserID": 3, "Name": "c", "UserNo": "3", "StoreID": 1, "PreDate": "2024-01-29"}]
    b = frames.bundle(spark, store=[frames.STORE], presence_view=pv)
    got = {r.uid: r for r in attendance.attendance(b, R, datetime(2024, 1, 30, 12)).collect()}
    assert set(got) == {"1", "2"}
    assert got["1"].hours == 8.5 and [tuple(p) for p in got["1"].punches] == [("22:00", "06:30")]
    assert got["2"].hours == 0.0 and [tuple(p) for p in got["2"].punches] == [("08:00", None)]
    assert got["1"].name == "a" and got["1"].date == "29/01"


def test_month_end_lookback(spark):
    row = spark.range(1).select(lookback(datetime(2024, 3, 31, 12), 1, "MONTH").alias("lb")).first()
    assert row.lb == datetime(2024, 2, 29, 12)


def test_feed_keys(spark):
    df = spark.createDataFrame([("5/3/2024",), ("bad",), ("1/1/1/1",), ("-/7/2024",)], "k string")
    got = [r.d for r in df.select(day_key_to_iso(F.col("k")).alias("d")).collect()]
    assert got == ["2024-03-05", "bad", "1/1/1/1", "2024-07--0"]


def test_feed_absent_and_present(spark):
    missing = os.path.join(tempfile.mkdtemp(prefix="possum-feed-"), "none")
    feed = read_feed(spark, missing)
    assert feed.count() == 0
    days = assemble.net_feed_days(feed.select("day_key", "net"))
    assert one(assemble.net_feed_today(days, datetime(2024, 3, 5))).net is None
    d = tempfile.mkdtemp(prefix="possum-feed-")
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump({"days": {"5/3/2024": 12.5, "6/3/2024": {"net": 3, "x": 1}}}, f)
    days = assemble.net_feed_days(read_feed(spark, d))
    assert float(one(assemble.net_feed_today(days, datetime(2024, 3, 5))).net) == 12.5
    obj = one(assemble.net_feed_today(days, datetime(2024, 3, 6)))
    assert float(obj.net) == 3 and json.loads(obj.raw) == {"net": 3, "x": 1}
    assert {r.day for r in days.collect()} == {"2024-03-05", "2024-03-06"}


def test_day_with_payments_only(spark):
    b = frames.bundle(spark, store=[frames.STORE],
                      pos_transaction=[{**_txn(1, None), "TransactionType": 14}],
                      tender_entry=[{"TransactionID": 1, "TenderID": 1, "Amount": 5, "Status": 1}],
                      tender=[{"TenderID": 1, "TenderNameHe": "Cash"}])
    from possum.operators import payments
    doc = one(assemble.day_documents(sales.sales_by_store_day(b, R), sales.sales_by_department_day(b, R),
                                     sales.sales_by_seller_day(b, R), payments.payments_by_day(b, R)))
    assert doc.stores == [] and doc.depts == [] and doc.sellers == []
    assert [(p.StoreName, p.PayMethod, p.TotalAmount, p.Cnt) for p in doc.payments] == [("S1", "Cash", 5.0, 1)]


def test_promotion_without_name(spark):
    red = spark.createDataFrame([("main", 8, "", "2024-01", "S1", Decimal(1), Decimal(2)),
                                 ("main", 9, "P", "2024-01", "S1", Decimal(1), Decimal(5)),
                                 ("main", 4, "P", "2024-02", "S1", Decimal(1), Decimal(1))],
                                "branch string, id int, name string, ym string, store string, "
                                "qty decimal(18,1), total decimal(18,2)")
    b = frames.bundle(spark)
    got = {r.key: r for r in promotions.promotion_matrix(red, b, R).collect()}
    assert got[R.promotion_prefix + "8"].name == "" and got[R.promotion_prefix + "8"].id == 8
    assert got["P"].id == 4 and got["P"].promo_total == 6.0 and set(got["P"].monthly) == {"2024-01", "2024-02"}


def test_optional_table_missing(spark):
    df = optional_table(spark, "ledger_monthly",
                        lambda: spark.read.parquet(os.path.join(tempfile.mkdtemp(), "nope")))
    assert df.count() == 0 and df.columns[:3] == ["Year", "Month", "Total"]


def test_user_in_two_branches_first_wins(spark):
    users = [{"UserId": 1, "UserNo": "7", "UserName": "u", "UserFName": "F", "UserLName": "L",
              "IsSuperAdmin": 1, "IsUser": 1, "Status": 1}]
    a = frames.bundle(spark, "A", store=[frames.STORE], users=users, user_store=[{"UserID": 1, "StoreID": 1}])
    b = frames.bundle(spark, "B", store=[frames.STORE], users=users, user_store=[{"UserID": 1, "StoreID": 1}])
    u = branches.union_branches([(a, None), (b, "LB")])
    rows = people.dedupe_first(people.user_directory(u, R), u, ["user", "hash"], ["no"]).collect()
    assert len(rows) == 1 and rows[0].branch == "A" and rows[0].store == "Main store"
    assert rows[0].role == "mgmt" and rows[0].display == "F L"


def test_relabel_collapses_store_map(spark):
    items = spark.createDataFrame([("A", "k", {"S1": Decimal("1.0"), "S2": Decimal("2.0")}),
                                   ("B", "k", {"S3": Decimal("1.5"), "S4": Decimal("2.0")})],
                                  "branch string, key string, s map<string,decimal(18,1)>")
    a = frames.bundle(spark, "A")
    b = frames.bundle(spark, "B")
    u = branches.union_branches([(a, None), (b, "LB")])
    got = {r.branch: r.s for r in branches.relabel_branch(items, u).collect()}
    assert got["A"] == {"S1": Decimal("1.0"), "S2": Decimal("2.0")}
    assert got["B"] == {"LB": Decimal("3.5")}


def test_merge_sum_keeps_first_other_fields(spark):
    df = spark.createDataFrame([("d", "x", 1.0, 2, 0), ("d", "y", 2.0, 3, 1), ("e", "z", 4.0, 1, 1)],
                               "k string, other string, v double, n long, rank int")
    got = {r.k: tuple(r) for r in branches.merge_sum(df, ["k"], ["v", "n"], ["rank"]).collect()}
    assert got == {"d": ("d", 3.0, 5, "x"), "e": ("e", 4.0, 1, "z")}


def test_low_stock_limit_per_branch(spark):
    items = [_item(i, name=f"i{i}", barcode=f"B{i}") for i in range(1, 8)]
    ist = [_ist(i, 1, i, rp=10) for i in range(1, 8)]
    b = _stock_bundle(spark, items, ist)
    got = [(r.Rank, r.Name) for r in stock.low_stock(b, R, n=3).orderBy("Rank").collect()]
    assert got == [(1, "i1"), (2, "i2"), (3, "i3")]


def test_rules_defaults_are_english():
    assert TEST_RULES.general_department == "PROMO" and R.general_department == "General"


def test_sale_months_lose_no_row_and_windows_keep_every_branch(spark):
    from possum.operators.base import MONTH, from_month
    from possum.sources.months import with_sale_months
    a = frames.bundle(spark, "A", pos_transaction=[_txn(100, None, ts="2001-01-05 10:00:00"), _txn(101, None, ts="2001-07-05 10:00:00")],
                      transaction_entry=[{"TransactionEntryID": 1, "TransactionID": 100, "Status": 1},
                                         {"TransactionEntryID": 2, "TransactionID": 101, "Status": 1},
                                         {"TransactionEntryID": 3, "TransactionID": 99, "Status": 1}])
    b = frames.bundle(spark, "B", pos_transaction=[_txn(100, None, ts="2001-07-06 10:00:00")],
                      transaction_entry=[{"TransactionEntryID": 4, "TransactionID": 100, "Status": 1}])
    u = with_sale_months(branches.union_branches([(a, None), (b, None)]))
    months = {(r.branch, r.TransactionEntryID): r[MONTH] for r in u["transaction_entry"].collect()}
    assert months == {("A", 1): "2001-01", ("A", 2): "2001-07", ("A", 3): "none", ("B", 4): "2001-07"}
    late = from_month(u["transaction_entry"], F.lit("2001-06-30").cast("timestamp_ntz"))
    assert {r.TransactionEntryID for r in late.collect()} >= {2, 4} and 1 not in {r.TransactionEntryID for r in late.collect()}
    plain = from_month(a["transaction_entry"], F.lit("2001-06-30").cast("timestamp_ntz"))
    assert plain.count() == 3   # no month stored: nothing is left out


def test_feed_choice_does_not_depend_on_row_order(spark):
    rows = [("1/8/2001", "7", "7", True, "2001-08-01 10:00:00", "b"), ("01/08/2001", "100", '{"net": 100}', False, "2001-08-01 10:00:00", "c"),
            ("1/8/2001", "9", "9", True, "2001-08-01 09:00:00", "z")]
    kinds = "day_key string, net string, raw string, session_ok boolean, fetched string, file string"
    for k in range(3):
        feed = spark.createDataFrame(rows[k:] + rows[:k], kinds).withColumn("net", F.col("net").cast("decimal(18,2)"))
        days = assemble.net_feed_days(feed)
        r = days.collect()[0]
        assert (r.day, float(r.net), r.raw, r.session_ok) == ("2001-08-01", 100.0, '{"net": 100}', False)
        t = assemble.net_feed_today(days, datetime(2001, 8, 1)).collect()[0]
        assert (float(t.net), t.sessionOk) == (100.0, False)
    bare = assemble.net_feed_days(spark.createDataFrame(rows[:1], kinds))
    assert assemble.net_feed_today(bare, datetime(2001, 8, 1)).collect()[0].sessionOk is None   # not an object


def test_null_store_names_are_labelled(spark, fixture_bundle):
    from possum.operators import stock
    from possum.operators.base import NO_STORE
    null = F.lit(None).cast("string")
    b = fixture_bundle.with_tables(store=fixture_bundle["store"].withColumn("StoreName", null).withColumn("StoreNameOrig", null))
    maps = stock.item_catalogue(stock.stock_lines(b, TEST_RULES)).select(F.map_keys("s").alias("k")).distinct().collect()
    assert [r.k for r in maps] == [[NO_STORE]]


def test_amounts_are_exact_decimals(spark):
    """One large and many small amounts: a sum of doubles would be off."""
    from possum.operators import sales
    stores = spark.createDataFrame([("2001-08-01", "big", Decimal("90000000000000.00"), 1)]
                                   + [("2001-08-01", f"s{k}", Decimal("0.01"), 1) for k in range(41)],
                                   "SaleDate string, StoreName string, TotalSales decimal(28,2), Transactions bigint")
    assert sales.daily_from_stores(stores).first().TotalSales == Decimal("90000000000000.41")
    assert sales.today_total(stores, datetime(2001, 8, 1)).first().TodayTotal == Decimal("90000000000000.41")



def test_day_document_list_order(spark):
    stores = spark.createDataFrame([("d", "B", 1.0, 1), ("d", None, 2.0, 1), ("d", "A", 3.0, 1)],
                                   "SaleDate string, StoreName string, TotalSales double, Transactions long")
    depts = spark.createDataFrame([("d", "x", 1.0), ("d", "y", 5.0), ("d", "z", None)],
                                  "SaleDate string, Dept string, TotalSales double")
    sellers = spark.createDataFrame([], "SaleDate string, SellerName string, TotalSales double, Transactions long")
    pays = spark.createDataFrame([], "SaleDate string, StoreName string, PayMethod string, TotalAmount double, Cnt long")
    doc = one(assemble.day_documents(stores, depts, sellers, pays))
    assert [s.StoreName for s in doc.stores] == ["A", "B", None]
    assert [d.Dept for d in doc.depts] == ["y", "x", "z"]
    assert doc.sellers == [] and doc.payments == []


def test_long_price_list_first_entry_wins(spark):
    n = 607
    plist = [(f"nomatch{i}", "1") for i in range(n)] + [("abc", "5"), ("a", "6")]
    items = _items(spark, [{"key": "k", "n": "xabcx", "b": "x", "p": 4},
                           {"key": "m", "n": "zzz", "b": "y", "p": 4},
                           {"key": "q", "n": "nomatch12", "b": "y", "p": 4}])
    got = _p(pricing.apply_price_list(items, plist))
    # "nomatch12" also contains "nomatch1": the earlier entry wins
    assert got == {"k": 5.0, "m": 4.0, "q": 1.0}


def test_union_with_a_branch_lacking_an_optional_table(spark):
    a = frames.bundle(spark, "A", ledger_monthly=[{"Year": 2024, "Month": 1, "Total": 5, "Cnt": 1}])
    b = frames.bundle(spark, "B")
    b = b.__class__({k: v for k, v in b.tables.items() if k != "ledger_monthly"}, b.branches)
    u = branches.union_branches([(a, None), (b, None)])
    assert [(r.branch, r.Year) for r in u["ledger_monthly"].collect()] == [("A", 2024)]
    broken = b.__class__({k: v for k, v in b.tables.items() if k != "store"}, b.branches)
    import pytest
    with pytest.raises(ValueError):
        branches.union_branches([(a, None), (broken, None)])


def test_impute_no_cascade(spark):
    items = _items(spark, [
        {"key": "a", "b": "25W0303M1", "p": 7},   # known: level-3 prefix 0303
        {"key": "b", "b": "24S0303M1", "p": 0},   # filled from a at level 3
        {"key": "c", "b": "24S0303M2", "p": 0},   # shares b's level-1 prefix; lookups see observed costs only
        {"key": "d", "b": "24S9999M1", "p": 0}])  # shares only the level-2/3 shape of nothing known
    got = _p(pricing.impute_cost(items))
    assert got["b"] == 7.0 and got["c"] == 7.0 and got["d"] == 0.0
    items = _items(spark, [
        {"key": "a", "b": "25W0303M1", "p": 7},
        {"key": "b", "b": "23X0404M1", "p": 0},
        {"key": "c", "b": "23X0404M2", "p": 0}])
    got = _p(pricing.impute_cost(items))
    assert got["b"] == 0.0 and got["c"] == 0.0   # nothing known for 0404: no value appears from nowhere


def test_low_stock_of_all_rows(spark, fixture_bundle):
    from possum.operators import stock
    every = stock.low_stock(fixture_bundle, TEST_RULES, n=stock.ALL_ROWS)
    assert every.count() > stock.low_stock(fixture_bundle, TEST_RULES, n=5).count() == 5
    assert every.where("Rank IS NOT NULL").count() == 0
