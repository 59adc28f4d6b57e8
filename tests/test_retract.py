"""Day sums under change: a refresh by retraction equals a full run."""

from __future__ import annotations

import os
import random
import tempfile
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from possum import schemas
from possum.bundle import Branch, Bundle
from possum.operators.daysums import DAY_SUMS, as_dataset, day_sums
from possum.plans.daily_job import run_daily_job
from possum.plans.publish import Manifest, commit, expire, read_manifest, read_published, versions
from possum.rules import Rules
from possum.sources.months import PARTITION_BY, with_sale_months
from possum.sources.parquet import read_bundle, write_bundle
from possum.sources.sinks import decimals_to_double
from possum.streaming import retract

from frames import STORE, table

RULES = Rules()
AS_OF = datetime(2024, 3, 31, 12)
T, L, N = retract.CHANGE_TABLES


class Shop:
    """A random branch database whose changes are recorded as images."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.rows = {T: {}, L: {}, N: {}}
        self.log = {T: [], L: [], N: []}
        self.next = 0
        for _ in range(60):
            self.sale()
        self.log = {name: [] for name in self.log}

    def put(self, name: str, key, row: dict | None) -> None:
        old = self.rows[name].pop(key, None)
        if old is not None:
            self.log[name].append((old, -1))
        if row is not None:
            self.rows[name][key] = row
            self.log[name].append((row, 1))

    def time(self) -> datetime:
        return datetime(2024, 1, 1) + timedelta(minutes=self.rng.randrange(90 * 1440))

    def amount(self) -> Decimal | None:
        return None if self.rng.random() < 0.05 else Decimal(self.rng.randrange(-5000, 20000)) / 100

    def sale(self) -> None:
        r, self.next = self.rng, self.next + 1
        i = self.next
        self.put(T, i, {"TransactionID": i, "StoreID": r.randrange(1, 5), "SaleTime": self.time(), "Total": self.amount(),
                        "TransactionType": r.choice([1, 1, 1, 14]), "SellerID": r.choice([None, 1, 2]), "Status": r.choice([1, 1, 1, -1])})
        for _ in range(r.randrange(4)):
            self.line(i)
        for k in range(r.randrange(3)):
            self.put(N, (i, k), {"TransactionID": i, "TenderID": r.randrange(1, 4), "Amount": self.amount(), "Status": r.choice([1, 1, -1])})

    def line(self, i: int, key=None) -> None:
        r, self.next = self.rng, self.next + 1
        self.put(L, key or self.next, {
            "TransactionEntryID": key or self.next, "TransactionID": i, "ItemStoreID": 1, "DepartmentID": r.choice([1, 2, None]), "Qty": 1,
            "Total": self.amount(), "TransactionEntryType": r.choice([1, 1, 4, 18]), "Status": r.choice([1, 1, 1, -1])})

    def change(self) -> None:
        r = self.rng
        what = r.choice(["void", "move", "move", "amount", "seller", "store", "delete", "new", "late", "line", "unline", "tender", "twice"])
        i = r.choice(list(self.rows[T]))
        t = self.rows[T][i]
        if what in ("void", "move", "amount", "seller", "store"):
            new = {"void": {"Status": -1}, "move": {"SaleTime": self.time()}, "amount": {"Total": self.amount()},
                   "seller": {"SellerID": r.choice([None, 1, 2])}, "store": {"StoreID": r.randrange(1, 5)}}[what]
            self.put(T, i, {**t, **new})
        elif what == "twice":
            self.put(T, i, {**t, "SaleTime": self.time()})
            self.put(T, i, {**t, "SaleTime": self.time(), "Status": 1})
        elif what == "delete":     # its lines stay behind, without a transaction
            self.put(T, i, None)
        elif what == "new":
            self.sale()
        elif what == "late":
            self.line(i)
        elif what in ("line", "unline") and self.rows[L]:
            k = r.choice(list(self.rows[L]))
            if what == "line":
                self.line(self.rows[L][k]["TransactionID"], k)
            else:
                self.put(L, k, None)
        elif what == "tender" and self.rows[N]:
            k = r.choice(list(self.rows[N]))
            self.put(N, k, r.choice([None, {**self.rows[N][k], "Amount": self.amount()}]))

    def bundle(self, spark) -> Bundle:
        given = {"store": [{**STORE, "StoreID": s, "StoreName": f"S{s % 3}", "Status": int(s != 4)} for s in range(1, 5)],
                 "department": [{"DepartmentID": 1, "Name": "D1"}], "tender": [{"TenderID": 1, "TenderNameHe": "Cash"}],
                 "users": [{"UserId": 1, "UserFName": "A ", "UserLName": "B", "Status": 1}],
                 **{name: list(self.rows[name].values()) for name in self.rows}}
        return Bundle({n: table(spark, n, given.get(n, [])) for n in schemas.DDL}, (Branch("main"),))

    def changes(self, spark) -> dict:
        out = {}
        for name, log in self.log.items():
            rows = table(spark, name, [r for r, _ in log]).collect()
            kind = schemas.schema(name).add("branch", "string").add("Sign", "integer")
            out[name] = spark.createDataFrame([(*row, sign) for row, (_, sign) in zip(rows, log, strict=True)], kind)
        self.log = {name: [] for name in self.log}
        return out


def full(bundle, name):
    return decimals_to_double(as_dataset(name, day_sums(name, bundle, RULES)))


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect()))


def same_as_full(spark, out, bundle):
    for name in DAY_SUMS:
        assert rows(read_published(spark, out, name).drop("SaleMonth")) == rows(full(bundle, name)), name


def test_batches_of_changes_equal_a_full_run(spark):
    """Voids, moves, late lines and all else, over facts whose lines stay in the month they were stored in."""
    shop = Shop(1)
    root = tempfile.mkdtemp(prefix="possum-retract-")
    out, canon = os.path.join(root, "out"), os.path.join(root, "c0")
    write_bundle(with_sale_months(shop.bundle(spark)), canon, PARTITION_BY)
    run_daily_job(read_bundle(spark, canon), RULES, AS_OF, out)
    home = {r.TransactionEntryID: r.SaleMonth for r in read_bundle(spark, canon)[L].select("TransactionEntryID", "SaleMonth").collect()}
    for n in range(1, 3):
        for _ in range(40):
            shop.change()
        now = shop.bundle(spark)
        stored = with_sale_months(now)
        # a line that was there stays in its folder, whatever became of its transaction
        old = spark.createDataFrame([(k, m) for k, m in home.items()], "TransactionEntryID long, was string")
        lines = stored[L].join(old, "TransactionEntryID", "left").withColumn("SaleMonth", F.coalesce("was", "SaleMonth")).drop("was")
        canon = os.path.join(root, f"c{n}")
        write_bundle(stored.with_tables(**{L: lines}), canon, PARTITION_BY)
        bundle = read_bundle(spark, canon)
        home |= {r.TransactionEntryID: r.SaleMonth for r in bundle[L].select("TransactionEntryID", "SaleMonth").collect()}
        changes = shop.changes(spark)
        # line feeds that name the month they are stored under
        changes[L] = changes[L].join(spark.createDataFrame([(k, m) for k, m in home.items()], "TransactionEntryID long, SaleMonth string"),
                                     "TransactionEntryID", "left").select(*changes[L].columns, F.coalesce("SaleMonth", F.lit("none")).alias("SaleMonth"))
        retract.apply_changes(bundle, RULES, changes, out, stream="s", batch=n)
        same_as_full(spark, out, now)
        # the same batch delivered again
        assert retract.apply_changes(bundle, RULES, changes, out, stream="s", batch=n) == []


def test_a_stream_of_image_files(spark):
    shop = Shop(7)
    root = tempfile.mkdtemp(prefix="possum-retract-stream-")
    out, canon = os.path.join(root, "out"), os.path.join(root, "c")
    write_bundle(shop.bundle(spark), canon)
    run_daily_job(read_bundle(spark, canon), RULES, AS_OF, out)
    feeds = {name: os.path.join(root, "feed", name) for name in retract.CHANGE_TABLES}
    for n in range(2):
        for _ in range(10):
            shop.change()
        for name, df in shop.changes(spark).items():
            df.coalesce(1).write.mode("append").parquet(feeds[name])
        after = os.path.join(root, f"after{n}")
        write_bundle(shop.bundle(spark), after)
        q = retract.start_retractions(spark, feeds, lambda p=after: read_bundle(spark, p), RULES, out, os.path.join(root, "ck"))
        q.awaitTermination(300)
        assert q.exception() is None
    same_as_full(spark, out, shop.bundle(spark))


def test_amounts_and_sellers_read_no_line(spark):
    shop = Shop(3)
    i, t = next((i, t) for i, t in shop.rows[T].items() if t["Status"] == 1 and t["TransactionType"] == 1 and t["StoreID"] != 4)
    shop.put(T, i, {**t, "Total": Decimal("1.23"), "SellerID": 2})
    changes = shop.changes(spark)
    assert retract.affected(changes).isEmpty()
    found = retract.day_differences(shop.bundle(spark), RULES, changes)
    assert set(found) == {"stores", "sellers"}
    assert sum(r.Amount for r in found["stores"].collect()) == Decimal("1.23") - (t["Total"] or 0)


def test_lines_are_read_in_the_months_of_the_images(spark):
    shop = Shop(4)
    root = tempfile.mkdtemp(prefix="possum-retract-plan-")
    write_bundle(with_sale_months(shop.bundle(spark)), root, PARTITION_BY)
    bundle = read_bundle(spark, root)
    i, t = next((i, t) for i, t in shop.rows[T].items() if t["SaleTime"].month == 1)
    shop.put(T, i, {**t, "SaleTime": datetime(2024, 2, 5)})
    changes = shop.changes(spark)
    ids = retract.affected(changes)
    moved = spark.createDataFrame([("main", i, "2023-12"), ("main", -1, "2020-01")], "branch string, TransactionID bigint, SaleMonth string")
    months = retract.image_months(changes, ids, moved)
    assert months == ["2023-12", "2024-01", "2024-02", "none"]
    plan = retract._lookup(bundle, ids, months)[L]._jdf.queryExecution().toString()
    assert "PartitionFilters: [SaleMonth" in plan and "2024-02" in plan and "2024-03" not in plan


def test_taking_back_what_is_not_there_fails(spark):
    shop = Shop(5)
    out = tempfile.mkdtemp(prefix="possum-retract-bad-")
    bundle = shop.bundle(spark)
    run_daily_job(bundle, RULES, AS_OF, out)
    before = read_manifest(spark, out)
    ghost = {"TransactionID": 999, "StoreID": 1, "SaleTime": datetime(2024, 1, 5), "Total": Decimal(1), "TransactionType": 1, "Status": 1}
    shop.log[T] = [(ghost, -1)] * 500
    with pytest.raises(PySparkException):
        retract.apply_changes(bundle, RULES, shop.changes(spark), out)
    assert read_manifest(spark, out) == before      # readers see what they saw


def test_manifest_versions(spark):
    out = tempfile.mkdtemp(prefix="possum-publish-")
    assert read_manifest(spark, out) is None
    for n in range(4):
        folder = os.path.join(out, f"run-{n}")
        spark.createDataFrame([(n,)], "x int").write.json(os.path.join(folder, "d"))
        assert commit(spark, out, Manifest(n, folder, ("d",))) == n + 1
    with pytest.raises(Exception, match="exist"):     # a second publisher of version 4 must start over
        commit(spark, out, Manifest(3, "elsewhere"))
    assert read_manifest(spark, out).folder.endswith("run-3")
    os.makedirs(os.path.join(out, "run-being-written"))
    expire(spark, out, keep=2)
    assert versions(spark, out) == [3, 4]
    assert sorted(d for d in os.listdir(out) if d.startswith("run")) == ["run-2", "run-3", "run-being-written"]
    assert [r.x for r in read_published(spark, out, "d").collect()] == [3]


@pytest.mark.parametrize("job", ["daily", "stock"])
def test_a_job_that_fails_half_way_changes_nothing(spark, monkeypatch, job):
    from possum.plans import daily_job, stock_job
    module, run = (daily_job, run_daily_job) if job == "daily" else (stock_job, stock_job.run_stock_job)
    out = tempfile.mkdtemp(prefix="possum-half-")
    bundle = Shop(6).bundle(spark)
    run(bundle, RULES, AS_OF, out)
    before = read_manifest(spark, out)
    calls, real = [], module.write_ordered

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("disk gone")
        return real(*args, **kwargs)

    monkeypatch.setattr(module, "write_ordered", failing)
    with pytest.raises(OSError, match="disk gone"):
        run(bundle, RULES, AS_OF, out)
    assert read_manifest(spark, out) == before


def test_two_recomputing_refreshes_keep_moved_lines(spark):
    """A transaction moves twice; its lines lie in the month it was first stored in."""
    from possum.streaming.refresh import refresh_months
    shop = Shop(8)
    i = next(i for i, t in shop.rows[T].items() if t["Status"] == 1 and t["TransactionType"] == 1 and t["StoreID"] != 4)
    shop.put(L, -5, {"TransactionEntryID": -5, "TransactionID": i, "DepartmentID": 1, "Qty": 1, "Total": Decimal("77.77"),
                     "TransactionEntryType": 1, "Status": 1})
    shop.put(T, i, {**shop.rows[T][i], "SaleTime": datetime(2024, 1, 3)})
    stored = with_sale_months(shop.bundle(spark))
    out = tempfile.mkdtemp(prefix="possum-moves-")
    run_daily_job(stored, RULES, AS_OF, out)
    jan, feb, mar = "2024-01", "2024-02", "2024-03"
    for months, day, moves in (([jan, feb], datetime(2024, 2, 4), [(jan, feb)]), ([feb, mar], datetime(2024, 3, 5), [(feb, mar)]),
                               ([mar], datetime(2024, 3, 5), [])):
        shop.put(T, i, {**shop.rows[T][i], "SaleTime": day})
        now = with_sale_months(shop.bundle(spark))
        mixed = stored.with_tables(pos_transaction=now[T])      # the lines' table is not rewritten
        refresh_months(mixed, RULES, months, out, moves=moves)
    assert read_manifest(spark, out).lines_of == {feb: (jan,), mar: (jan, feb)}
    same_as_full(spark, out, shop.bundle(spark))
