"""Salted joins, long price lists and mergeable document counts."""

from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal
from statistics import median

from pyspark.sql import functions as F

from possum.operators import pricing, promotions, sales, skew, suppliers
from possum.rules import Rules
from possum_checks.params import AS_OF, PRICE_LIST
from possum_checks.params import RULES as FIXTURE_RULES
from possum_checks.queries import long_price_list

from frames import STORE, bundle

RULES = Rules()
KEY = ["branch", "TransactionID"]


def rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect())


def hot_bundle(spark, lines=30_000):
    """One transaction holds a third of all lines, every one of them discounted."""
    b = bundle(spark, store=[STORE, {**STORE, "StoreID": 2, "StoreName": "S2"}], promotion=[{"ID": 1, "Description": "P"}],
               transaction_discounts=[{"TDiscountID": 1, "PromotionID": 1, "Status": 1}])
    i = F.col("id")
    t = spark.range(2000).select(
        F.lit("main").alias("branch"), i.alias("TransactionID"), (1 + i % 2).cast("int").alias("StoreID"),
        (F.lit(datetime(2024, 1, 5)).cast("timestamp_ntz") + F.expr("make_dt_interval(cast(id % 40 as int))")).alias("SaleTime"),
        F.lit(Decimal(1)).cast("decimal(18,2)").alias("Total"), F.lit(1).alias("TransactionType"), F.lit(1).cast("long").alias("SellerID"), F.lit(1).alias("Status"))
    te = spark.range(lines).select(
        F.lit("main").alias("branch"), i.alias("TransactionEntryID"),
        F.when(i % 3 == 0, 7).when(i % 1000 == 1, F.lit(None)).otherwise(i % 2000).cast("long").alias("TransactionID"),
        i.alias("ItemStoreID"), (i % 3).cast("int").alias("DepartmentID"), F.lit(1).cast("decimal(18,1)").alias("Qty"),
        (i % 100).cast("decimal(18,2)").alias("Total"), F.lit(1).alias("TransactionEntryType"), F.lit(1).alias("Status"))
    ted = te.select("branch", F.lit(1).cast("long").alias("TDiscountID"), "TransactionEntryID", F.col("Qty").alias("QtyInSale"),
                    F.col("Total").alias("DiscAmount"), F.lit(1).alias("Status"))
    return b.with_tables(pos_transaction=t, transaction_entry=te, tentry_discount=ted)


def test_heavy_keys_are_found(spark):
    b = hot_bundle(spark)
    heavy = skew.heavy_keys(b["transaction_entry"], KEY, share=0.01)
    assert list(heavy.salts) == ["main\x1f7"] and heavy.salts["main\x1f7"] >= 16 * 8 / 3
    assert skew.heavy_keys(b["pos_transaction"], KEY, share=0.01).salts == {}
    assert skew.heavy_keys(b["pos_transaction"].limit(0), KEY).salts == {}


def test_salted_datasets_are_the_same(spark):
    b = hot_bundle(spark)
    heavy = skew.heavy_keys(b["transaction_entry"], KEY, share=1e-3)
    as_of = datetime(2024, 3, 1)
    assert rows(sales.sales_by_department_day(b, RULES, heavy)) == rows(sales.sales_by_department_day(b, RULES))
    assert rows(promotions.promotion_redemptions(b, RULES, as_of, heavy)) == rows(promotions.promotion_redemptions(b, RULES, as_of))


def test_no_task_of_the_hot_transaction_is_twice_the_median(spark, tmp_path):
    """Facts stored in buckets of their key: the cold rows join without an exchange, the hot ones are dealt evenly."""
    b = hot_bundle(spark, 120_000)
    names = {"pos_transaction": "skew_t", "transaction_entry": "skew_te"}
    for name, saved in names.items():
        b[name].write.mode("overwrite").bucketBy(8, *KEY).sortBy(*KEY).saveAsTable(saved)
    t, te = (spark.table(n) for n in names.values())
    heavy = skew.heavy_keys(te, KEY, share=1e-3)
    keep = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        t = t.select(*KEY, "SaleTime")
        joined = skew.salted_join(te, t, heavy)
        tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain = [r["count"] for r in te.join(t, KEY).groupBy(F.spark_partition_id().alias("p")).count().collect()]
        text = joined._jdf.queryExecution().executedPlan().toString()
        count = joined.count()
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    assert count == te.join(t, KEY).count()
    assert max(plain) > 3 * median(plain) and max(tasks) <= 2 * median(tasks)
    assert text.count("Exchange hashpartitioning") == 2      # the salted rows of either side, nothing else


def items_of(spark, names):
    return spark.createDataFrame([("main", str(k), n, Decimal("1.00")) for k, n in enumerate(names)], "branch string, key string, n string, p decimal(18,2)")


def first_match(names, entries):
    return [min(((p, c) for p, e, c in entries if e is not None and n is not None and e in n), default=(None, Decimal("1.00")))[1] for n in names]


def test_long_price_list_against_all_pairs(spark):
    rng = random.Random(3)
    for short in (False, True):
        names = ["".join(rng.choices("abcé ", k=rng.randrange(0, 12))) for _ in range(150)] + [None, "", "aaaa", "abcabcabc"]
        entries = [(k // 2, "".join(rng.choices("abcé ", k=rng.randrange(0 if short and k > 290 else 3, 6))), Decimal(rng.randrange(100, 999)) / 100) for k in range(300)]
        entries += [(0, "aaaaaaaaaaaaaaa", Decimal("9.99")), (1, None, Decimal("9.98")), (900, entries[5][1], Decimal("9.97"))]
        entries = [e if e[1] is None or short or len(e[1]) > 2 else (e[0], "zzz", e[2]) for e in entries]
        df = spark.createDataFrame(entries, "position int, name string, price decimal(18,2)")
        got = {r.key: r.p for r in pricing.apply_long_price_list(items_of(spark, names), df).collect()}
        assert [got[str(k)] for k in range(len(names))] == first_match(names, entries)


def test_long_price_list_equals_the_literal_form(spark, fixture_bundle):
    from possum_checks.queries import catalogue
    items = catalogue(fixture_bundle).select("branch", "key", "n", "p")
    short = spark.createDataFrame([(k, n, Decimal(p)) for k, (n, p) in enumerate(PRICE_LIST)], "position int, name string, price decimal(18,2)")
    assert rows(pricing.apply_long_price_list(items, short)) == rows(pricing.apply_price_list(items, PRICE_LIST))
    assert rows(pricing.apply_long_price_list(items, short.limit(0))) == rows(items)


def test_a_hundred_thousand_entries(spark, fixture_bundle):
    """No nested loop, and the same prices as when the few entries that match stand alone."""
    base = long_price_list(fixture_bundle)
    many = spark.range(100_000).select((10**6 + F.col("id")).alias("position"), F.concat(F.lit("entry "), F.sha2(F.col("id").cast("string"), 256)).alias("name"),
                                       F.lit(Decimal("5.00")).cast("decimal(18,2)").alias("price"))
    items = items_of(spark, [r.Name for r in fixture_bundle["item_main"].select("Name").distinct().collect()])
    df = pricing.apply_long_price_list(items, base.withColumn("position", F.col("position").cast("long")).unionByName(many))
    assert rows(df) == rows(pricing.apply_long_price_list(items, base))
    text = df._jdf.queryExecution().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_document_counts_from_merged_states(spark, fixture_bundle):
    b = fixture_bundle
    want = rows(suppliers.supplier_monthly(b, FIXTURE_RULES, AS_OF))
    e = b["suppliers_docs_entry"]
    # three parts of the lines: documents lie in several of them
    parts = [suppliers.supplier_month_state(b.with_tables(suppliers_docs_entry=e.where(F.col("Qty").cast("int") % 3 == k)), FIXTURE_RULES, AS_OF) for k in range(3)]
    state = suppliers.merge_month_states(suppliers.merge_month_states(*parts[:2]), parts[2])
    assert rows(suppliers.supplier_monthly_from_state(state, FIXTURE_RULES)) == want
    # merging a state of the same documents with no new amount counts no document twice
    again = suppliers.merge_month_states(state, state.withColumn("amount", F.lit(0).cast(state.schema["amount"].dataType)))
    assert rows(suppliers.supplier_monthly_from_state(again, FIXTURE_RULES)) == want
    one = suppliers.supplier_month_state(b, FIXTURE_RULES, AS_OF)
    spark_plan = one._jdf.queryExecution().executedPlan().toString()
    assert "countDistinct" not in spark_plan and "bit_or" in spark_plan


def test_document_bits_of_any_id(spark):
    """Negative ids, both ends of a word and large ids have bits of their own."""
    ids = [-130, -65, -64, -63, -1, 0, 1, 62, 63, 64, 127, 128, 2**62, 2**62 + 1]
    b = bundle(spark, suppliers_docs=[{"ID": i, "DateT": "2001-07-05", "Type": 1, "DocStatus": 7, "Status": 1, "SupplierID": 1, "StoreID": 1} for i in ids],
               suppliers_docs_entry=[{"ID": i, "Status": 1, "ExtPrice": 2, "Cost": 1, "Qty": 1} for i in ids for _ in range(2)],
               supplier_dim=[{"SupplierID": 1, "Name": "S"}])
    got = suppliers.supplier_monthly_from_state(suppliers.supplier_month_state(b, RULES, AS_OF), RULES).collect()
    assert [(r.DocCount, r.TotalAmount) for r in got] == [(len(ids), 4.0 * len(ids))]


def test_entries_of_one_name_are_posted_once(spark):
    """Thousands of entries of one name: the first position wins, and one row of the name meets the names."""
    many = spark.range(5000).select((F.col("id") + 7).cast("int").alias("position"), F.lit("widget").alias("name"), F.lit(Decimal("3.00")).cast("decimal(18,2)").alias("price"))
    first = spark.createDataFrame([(3, "widget", Decimal("2.00")), (3, "widget", Decimal("1.50")), (2, None, Decimal("9.00"))], "position int, name string, price decimal(18,2)")
    items = items_of(spark, ["small widget", "ring", None])
    df = pricing.apply_long_price_list(items, many.unionByName(first))
    assert {r.key: r.p for r in df.collect()} == {"0": Decimal("1.50"), "1": Decimal("1.00"), "2": Decimal("1.00")}
    assert "Aggregate [name" in df._jdf.queryExecution().optimizedPlan().toString()


def test_affected_rows_are_looked_up_once(spark, fixture_bundle):
    """The affected ids and their rows are kept, with the columns that sums read; the differences are those of the lazy plan."""
    from possum.streaming import retract
    b = fixture_bundle
    few = {n: b[n].where(F.col("TransactionID") % 40 == 0) for n in retract.CHANGE_TABLES}
    changes = {n: df.withColumn("Sign", F.lit(1)) for n, df in few.items()}
    kept = {}

    def put(name, df):
        kept[name] = df
        return df
    got = retract.day_differences(b, RULES, changes, put=put)
    assert set(kept) == {"affected"} | {f"{k}-{n}" for k in ("now", "was") for n in retract.CHANGE_TABLES}
    assert "Qty" not in kept["now-transaction_entry"].columns and kept["was-transaction_entry"].isEmpty()
    for name, df in retract.day_differences(b, RULES, changes).items():
        assert rows(df) == rows(got[name])


def test_changed_rows_against_two_counts(spark):
    """Images of altered, dropped, repeated and null rows, against the difference of both tables as multisets."""
    from collections import Counter

    from possum_checks.queries import changed_rows
    now = spark.createDataFrame([(1, 5), (1, 5), (2, None), (2, 6), (3, 6), (4, 8), (None, 1), (4, 9)], "k int, v int")
    kept, altered = F.col("k") % 3 != 0, {"v": F.when(F.col("k") == 4, F.col("v") + 1).when(F.col("k") == 1, None).otherwise(F.col("v"))}
    a, b = Counter(map(tuple, now.collect())), Counter(map(tuple, now.where(kept).withColumns(altered).select("k", "v").collect()))
    want = Counter({(*r, 1): n for r, n in (a - b).items()}) + Counter({(*r, -1): n for r, n in (b - a).items()})
    got = changed_rows(now, kept, altered)
    assert Counter(map(tuple, got.collect())) == want
    # rows that stay as they were don't reach the exchange
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Filter NOT") > plan.rindex("Aggregate")
