"""Incremental refresh of the daily datasets.

The reference recomputes the whole sales history on every run. Here a
Structured Streaming source of changes (new or edited rows of the
transaction, sale-line and tender-line tables, e.g. files dropped by change
capture) drives the refresh: each micro-batch finds the sale months it touches, recomputes the
day-keyed datasets (D10-D14 and the date document D23) for those months
only, writes them into a folder of their own and publishes them as a whole
(:mod:`possum.plans.publish`). Other months are neither read for output nor
rewritten. A feed that carries before and after images needs no month
recomputed: :mod:`possum.streaming.retract`.

Exactness: every refreshed dataset groups by the sale day, so a month's
rows depend only on that month's transactions; recomputing a touched month
from the full tables gives the same rows as a full run.

Failures: ``foreachBatch`` delivers a micro-batch at least once. The batch
function is idempotent (recompute the touched months from the tables),
so a batch replayed after a lost driver or executor leaves the same output.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from possum import schemas
from possum.bundle import Bundle
from possum.functions.dates import month_label
from possum.operators import assemble, payments, sales
from possum.operators.base import MONTH
from possum.operators.daysums import DAY_SUMS, as_dataset, day_sums
from possum.plans.common import Stage, write_clustered, write_ordered
from possum.plans.daily_job import ORDER, with_month
from possum.plans.publish import Manifest, commit, expire, read_manifest, with_moves
from possum.rules import Rules
from possum.sources.months import NO_MONTH

DAY_DATASETS: dict[str, Callable[[Bundle, Rules], DataFrame]] = {
    "stores": sales.sales_by_store_day,
    "depts": sales.sales_by_department_day,
    "sellers": sales.sales_by_seller_day,
    "payments": payments.payments_by_day,
}


# change feeds the refresh follows: the tables the day-keyed datasets read
# per transaction (a change to a dimension table needs a full daily run)
CHANGE_TABLES = ("pos_transaction", "transaction_entry", "tender_entry")


def touched_months(changes: DataFrame, bundle: Bundle) -> list[str]:
    """Sale months touched by a batch of changes, a short list on the driver.

    ``changes`` has branch, TransactionID, SaleTime and SaleTimeBefore. A moved
    transaction touches the month it came from (its before image) as well as
    the month it is in. SaleTime is null for changed lines (sale or tender
    lines carry no date), whose months come from their transactions, matched
    by branch and id (ids are per branch; a change without branch matches any).
    """
    dated = changes.select(F.explode(F.array("SaleTime", "SaleTimeBefore")).alias("t")).where("t IS NOT NULL")
    ids = changes.where(F.col("SaleTime").isNull()).select(F.col("branch").alias("b"), F.col("TransactionID").alias("id"))
    t = bundle["pos_transaction"]
    same = (t["TransactionID"] == F.col("id")) & (F.col("b").isNull() | (t["branch"] == F.col("b")))
    undated = t.join(ids, same, "left_semi").select(F.col("SaleTime").alias("t"))
    months = dated.unionByName(undated).select(month_label(F.col("t")).alias(MONTH)).distinct()
    return sorted(r[0] for r in months.where(F.col(MONTH).isNotNull()).toLocalIterator())


def month_moves(changes: DataFrame) -> list[tuple[str, str]]:
    """(old, new) sale months of the moved transactions of a batch, a short list on the driver."""
    moves = changes.where(F.col("SaleTimeBefore").isNotNull() & F.col("SaleTime").isNotNull()).select(
        month_label(F.col("SaleTimeBefore")).alias("old"), month_label(F.col("SaleTime")).alias("new")).where("old <> new").distinct()
    return sorted((r.old, r.new) for r in moves.toLocalIterator())


def restrict_to_months(bundle: Bundle, months: Sequence[str], line_months: Sequence[str] = ()) -> Bundle:
    """The bundle with its transactions limited to ``months``.

    The bounds on SaleTime reach the scan. Facts stored with their sale month
    (:mod:`possum.sources.months`) are limited on that partition column, so the
    other months' folders are not listed. Lines stay in the folder they were
    stored in when their transaction moves: ``line_months`` are further folders
    that may hold lines of these months, and lines that came before their
    transaction lie in one of their own.
    """
    months = sorted(months)
    t = bundle["pos_transaction"]
    if not months:
        return bundle.with_tables(pos_transaction=t.where(F.lit(False)))
    first, last = (F.to_timestamp_ntz(F.lit(f"{m}-01"), F.lit("yyyy-MM-dd")) for m in (months[0], months[-1]))
    t = t.where((F.col("SaleTime") >= first) & (F.col("SaleTime") < last + F.expr("INTERVAL 1 MONTH"))
                & month_label(F.col("SaleTime")).isin(*months))
    tables = {"pos_transaction": t.where(F.col(MONTH).isin(*months)) if MONTH in t.columns else t}
    folders = sorted({*months, *line_months, NO_MONTH})
    for name in CHANGE_TABLES[1:]:
        df = bundle[name]
        tables[name] = df.where(F.col(MONTH).isin(*folders)) if MONTH in df.columns else df
    return bundle.with_tables(**tables)


def refresh_months(bundle: Bundle, rules: Rules, months: Sequence[str], out_dir: str, fmt: str = "json", keep: int = 2,
                   moves: Sequence[tuple[str, str]] = ()) -> None:
    """Recompute the day-keyed datasets (and the date document) for ``months``,
    write them into a folder of their own and publish that: readers see all of
    them change at once. A month that has no rows any more has none there.

    ``moves`` are the (old, new) months of transactions that moved. The manifest
    keeps them, so a later refresh of the new month still finds lines stored
    under the old one.
    """
    if not months:
        return
    spark = bundle.spark
    last = read_manifest(spark, out_dir)
    lines_of = with_moves(last.lines_of if last else {}, moves)
    scoped = restrict_to_months(bundle, months, sorted({f for m in months for f in lines_of.get(m, ())}))
    stage = Stage(spark, "refresh")
    folder = os.path.join(out_dir, f"refresh-{uuid.uuid4().hex}")
    sums = {name: stage.put(name, day_sums(name, scoped, rules)) for name in DAY_SUMS}
    built = {name: as_dataset(name, df) for name, df in sums.items()}
    built["daily"] = sales.daily_from_stores(built["stores"])
    built["by_date"] = assemble.day_documents(built["stores"], built["depts"], built["sellers"],
                                              built["payments"])
    for name, df in built.items():
        write_ordered(bundle, with_month(df), os.path.join(folder, name), ORDER.get(name, ()), fmt, partition_by=[MONTH])
    for name, df in sums.items():
        write_clustered(with_month(df), os.path.join(folder, "_state", name), MONTH)
    m = last or Manifest(0, folder, tuple(sorted(built)))
    commit(spark, out_dir, m._replace(months={**m.months, **{k: folder for k in months}}, lines_of=lines_of))
    stage.drop()
    expire(spark, out_dir, keep)


def change_stream(spark: SparkSession, changes: Mapping[str, str]) -> DataFrame:
    """One stream of (branch, TransactionID, SaleTime, SaleTimeBefore) over the
    change feeds, given as table -> folder of Parquet files with that table's
    schema. A feed may also carry ``branch``, and a transaction feed
    ``SaleTimeBefore``, the time before the change; without them they are null."""
    streams = []
    for table, path in changes.items():
        if table not in CHANGE_TABLES:
            raise ValueError(f"{table} is not followed incrementally; run the full daily job")
        none = F.lit(None).cast("timestamp_ntz")
        schema = schemas.schema(table).add("branch", "string")
        if table == "pos_transaction":
            schema = schema.add("SaleTimeBefore", "timestamp_ntz")
        s = spark.readStream.schema(schema).parquet(path)
        ts, before = (F.col("SaleTime"), F.col("SaleTimeBefore")) if table == "pos_transaction" else (none, none)
        streams.append(s.select("branch", "TransactionID", ts.alias("SaleTime"), before.alias("SaleTimeBefore")))
    return reduce(lambda a, b: a.unionByName(b), streams)


def start_refresh(spark: SparkSession, changes: str | Mapping[str, str], load_bundle: Callable[[], Bundle],
                  rules: Rules, out_dir: str, checkpoint_location: str,
                  available_now: bool = True, fmt: str = "json") -> StreamingQuery:
    """Start the refresh stream over the change feeds.

    ``changes`` is a folder of changed transactions, or a mapping of the
    followed tables (``CHANGE_TABLES``) to their change folders.
    ``checkpoint_location`` must be on shared storage (the query's progress
    and source offsets live there, so a restarted driver resumes where it
    stopped). ``load_bundle`` returns the current canonical tables.
    """
    feeds = {"pos_transaction": changes} if isinstance(changes, str) else dict(changes)
    source = change_stream(spark, feeds)

    def batch(batch_changes: DataFrame, _epoch: int) -> None:
        bundle = load_bundle()
        batch_changes = batch_changes.persist()
        refresh_months(bundle, rules, touched_months(batch_changes, bundle), out_dir, fmt, moves=month_moves(batch_changes))
        batch_changes.unpersist()

    writer = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
