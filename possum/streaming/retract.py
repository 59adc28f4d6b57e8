"""The daily datasets under change, by retraction.

Every day-keyed dataset is a sum over rows, so a change adds the after image of
what it touches and takes back the before image. The published run keeps the
exact day sums (amount and number of rows) of D10, D11, D12 and D14; a batch of
changes is turned into differences of these sums, and only the months with a
difference are written again, from stored day sums. The sale history is not
read:

- D10, D12 and D13 sum transactions. Their differences come from the images in
  the feed alone.
- D11 and D14 sum lines by a day that the lines get from their transaction. A
  batch affects the transactions whose lines changed and those whose day, store,
  type or status did; their lines are looked up by id, in the sale months the
  images name where the facts are stored by month. An amount or a seller that
  changes reads no line.

Images are rows of a table with ``Sign``: -1 for a row as it was, +1 for a row as
it is. A new row has no before image, a deleted one no after image; a row that
changes twice in a batch may have both images twice. The tables must hold the
changes of the batch and none after it.

Lines stay in the month folder they were stored in when their transaction moves.
The state therefore remembers the months of every moved transaction (``moved``),
so a second move still finds its lines.

Exactly once: the manifest that publishes a batch also names it, and a batch that
a restarted stream delivers again is skipped.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from possum import schemas
from possum.bundle import Bundle
from possum.functions.dates import month_label
from possum.operators import assemble, sales
from possum.operators.base import MONTH
from possum.operators.daysums import DAY_SUMS, as_dataset, day_sums
from possum.plans.common import Stage, write_clustered, write_ordered
from possum.plans.daily_job import ORDER, with_month
from possum.plans.publish import commit, exists, expire, read_manifest, read_version, with_moves
from possum.rules import Rules
from possum.sources.months import NO_MONTH

SIGN = "Sign"
CHANGE_TABLES = ("pos_transaction", "transaction_entry", "tender_entry")
KEY = ["branch", "TransactionID"]
# what the lines of a transaction take from it
_PASSED_ON = ["StoreID", "SaleTime", "TransactionType", "Status"]
# what the sums of lines (D11, D14) read of each table
_READ = {"pos_transaction": [*KEY, *_PASSED_ON], "transaction_entry": [*KEY, "DepartmentID", "TransactionEntryType", "Total", "Status"],
         "tender_entry": [*KEY, "TenderID", "Amount", "Status"]}


def images(changes: DataFrame, sign: int) -> DataFrame:
    return changes.where(F.col(SIGN) == sign).drop(SIGN)


def _net(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``columns`` whose images do not cancel out, with their net Sign."""
    return changes.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) != 0)


def affected(changes: Mapping[str, DataFrame]) -> DataFrame:
    """branch, TransactionID of the transactions whose lines, or whose lines' day or store, changed."""
    ids = _net(changes["pos_transaction"], [*KEY, *_PASSED_ON]).select(*KEY)
    for name in CHANGE_TABLES[1:]:
        ids = ids.unionByName(changes[name].select(*KEY))
    return ids.distinct()


def before(after: DataFrame, changes: DataFrame) -> DataFrame:
    """The rows as they were: ``after`` without the after images, with the before images."""
    columns = [c for c in after.columns if c in changes.columns]
    both = after.select(*columns, F.lit(1).alias(SIGN)).unionByName(changes.select(*columns, (-F.col(SIGN)).alias(SIGN)))
    was = _net(both, columns).where(F.col(SIGN) > 0)
    # equal rows are told apart by their number only
    return was.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(SIGN).cast("int")))).select(*columns)


def image_months(changes: Mapping[str, DataFrame], ids: DataFrame, moved: DataFrame | None) -> list[str] | None:
    """Sale months in which rows of the affected transactions may be stored.

    A short list on the driver. None if a changed line names no month and its
    transaction did not change: then nothing but the tables can tell.
    """
    t = changes["pos_transaction"].select(*KEY, F.coalesce(month_label(F.col("SaleTime")), F.lit(NO_MONTH)).alias("m"))
    lines = None
    for name in CHANGE_TABLES[1:]:
        c = changes[name]
        part = c.select(*KEY, (F.col(MONTH) if MONTH in c.columns else F.lit(None).cast("string")).alias("m"))
        lines = part if lines is None else lines.unionByName(part)
    unknown = lines.where(F.col("m").isNull()).join(t.select(*KEY), KEY, "left_anti")
    if not unknown.isEmpty():
        return None
    found = t.select("m").unionByName(lines.where(F.col("m").isNotNull()).select("m"))
    if moved is not None:
        found = found.unionByName(moved.join(ids, KEY, "left_semi").select(F.col(MONTH).alias("m")))
    return sorted({NO_MONTH, *(r.m for r in found.distinct().toLocalIterator())})


def _lookup(bundle: Bundle, ids: DataFrame, months: Sequence[str] | None) -> Bundle:
    """What the sums of lines read of the given transactions' facts; facts stored by month are read in ``months`` only."""
    def some(name: str) -> DataFrame:
        df = bundle[name]
        if months is not None and MONTH in df.columns:
            df = df.where(F.col(MONTH).isin(*months))
        return df.select(*_READ[name]).join(ids, KEY, "left_semi")

    return bundle.with_tables(**{name: some(name) for name in CHANGE_TABLES})


def day_differences(bundle: Bundle, rules: Rules, changes: Mapping[str, DataFrame], moved: DataFrame | None = None,
                    put: Callable[[str, DataFrame], DataFrame] = lambda _name, df: df) -> dict[str, DataFrame]:
    """Differences of the day sums (keys, Amount, Rows) that a batch of changes makes.

    ``bundle`` holds the tables after the changes. The affected transactions and
    their rows, which are read several times, are kept with ``put`` (of a stage).
    """
    t = changes["pos_transaction"]
    out = {}
    for name in ("stores", "sellers"):
        out[name] = _minus(*(day_sums(name, bundle.with_tables(pos_transaction=images(t, s)), rules) for s in (1, -1)))
    ids = put("affected", affected(changes))
    if not ids.isEmpty():
        now = _lookup(bundle, ids, image_months(changes, ids, moved))
        now = now.with_tables(**{name: put(f"now-{name}", now[name]) for name in CHANGE_TABLES})
        # a transaction may have more than the images in the feed: all its rows are taken back and added anew
        was = now.with_tables(**{name: put(f"was-{name}", before(now[name], changes[name].join(ids, KEY, "left_semi"))) for name in CHANGE_TABLES})
        for name in ("depts", "payments"):
            out[name] = _minus(day_sums(name, now, rules), day_sums(name, was, rules))
    return out


def _minus(a: DataFrame, b: DataFrame) -> DataFrame:
    keys = [c for c in a.columns if c not in ("Amount", "Rows")]
    both = a.unionByName(b.select(*keys, (-F.col("Amount")).alias("Amount"), (-F.col("Rows")).alias("Rows")))
    return add(both, keys).where((F.col("Amount") != 0) | (F.col("Rows") != 0))


def add(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Day sums of the same keys added up."""
    return parts.groupBy(*keys).agg(F.sum("Amount").cast("decimal(38,2)").alias("Amount"), F.sum("Rows").alias("Rows"))


def merge(state: DataFrame, difference: DataFrame) -> DataFrame:
    """The day sums after a difference; a group without rows is gone.

    A group of negative count means that the feed takes back rows which the state
    never had: the query fails rather than publish it.
    """
    keys = [c for c in difference.columns if c not in ("Amount", "Rows")]
    both = add(state.select(*keys, "Amount", "Rows").unionByName(difference), keys)
    checked = F.when(F.col("Rows") < 0, F.raise_error(F.lit("a change takes back rows that the day sums do not hold; run the full job")))
    return both.withColumn("Rows", F.coalesce(checked.cast("bigint"), F.col("Rows"))).where(F.col("Rows") > 0)


def newly_moved(changes: Mapping[str, DataFrame]) -> DataFrame:
    """branch, TransactionID, SaleMonth: all months of the transactions whose images name several."""
    t = changes["pos_transaction"].select(*KEY, F.coalesce(month_label(F.col("SaleTime")), F.lit(NO_MONTH)).alias(MONTH))
    g = t.groupBy(*KEY).agg(F.collect_set(MONTH).alias("months")).where(F.size("months") > 1)
    return g.select(*KEY, F.explode("months").alias(MONTH))


def apply_changes(bundle: Bundle, rules: Rules, changes: Mapping[str, DataFrame], out_dir: str, fmt: str = "json",
                  stream: str | None = None, batch: int = 0, keep: int = 2) -> list[str]:
    """Apply a batch of changes to the published run and publish the result as a whole.

    Returns the months that changed. ``stream`` and ``batch`` name the batch: one
    that has been published is not applied again.
    """
    spark = bundle.spark
    m = read_manifest(spark, out_dir)
    if m is None or not exists(spark, os.path.join(m.folder, "_state")):
        raise ValueError(f"{out_dir} holds no published daily run with day sums; run the daily job first")
    if stream is not None and m.applied.get(stream, -1) >= batch:
        return []
    stage = Stage(spark, "retract")
    moved = spark.read.parquet(m.moved) if m.moved else None
    differences = {name: stage.put(f"difference-{name}", with_month(df)) for name, df in day_differences(bundle, rules, changes, moved, stage.put).items()}
    months = sorted({r[0] for df in differences.values() for r in df.select(MONTH).distinct().toLocalIterator()})
    folder = os.path.join(out_dir, f"refresh-{uuid.uuid4().hex}")
    built = {}
    for name, (keys, _, _) in DAY_SUMS.items():
        state = read_version(spark, m, f"_state/{name}", "parquet", months).select(*keys, "Amount", "Rows") if months else None
        if state is None:
            continue
        new = merge(state, differences[name].drop(MONTH)) if name in differences else state
        path = os.path.join(folder, "_state", name)
        write_clustered(with_month(new), path, MONTH)
        built[name] = as_dataset(name, spark.read.parquet(path).select(*keys, "Amount", "Rows"))
    if months:
        public = {**built, "daily": sales.daily_from_stores(built["stores"]),
                  "by_date": assemble.day_documents(built["stores"], built["depts"], built["sellers"], built["payments"])}
        for name, df in public.items():
            write_ordered(bundle, with_month(df), os.path.join(folder, name), ORDER.get(name, ()), fmt, partition_by=[MONTH])
    fresh = stage.put("moved", newly_moved(changes))
    if not fresh.isEmpty():
        path = os.path.join(folder, "_state", "moved")
        (fresh if moved is None else fresh.unionByName(moved)).distinct().write.parquet(path)
        pairs = fresh.withColumnRenamed(MONTH, "old").join(fresh.withColumnRenamed(MONTH, "new"), KEY).where("old <> new").select("old", "new").distinct()
        m = m._replace(moved=path, lines_of=with_moves(m.lines_of, [(r.old, r.new) for r in pairs.toLocalIterator()]))
    applied = {**m.applied, **({stream: batch} if stream is not None else {})}
    commit(spark, out_dir, m._replace(months={**m.months, **{k: folder for k in months}}, applied=applied))
    stage.drop()
    expire(spark, out_dir, keep)
    return months


def image_stream(spark: SparkSession, feeds: Mapping[str, str]) -> DataFrame:
    """The images of all feeds as one stream: table, and its row as a struct of the table's name.

    A feed is a folder of Parquet files with the table's columns, ``branch`` and
    ``Sign``; line feeds may carry the SaleMonth they are stored under.
    """
    streams = []
    kinds = {name: schemas.schema(name).add("branch", "string").add(SIGN, "integer").add(MONTH, "string") for name in CHANGE_TABLES}
    for table, path in feeds.items():
        if table not in CHANGE_TABLES:
            raise ValueError(f"{table} is not followed incrementally; run the full daily job")
        rows = spark.readStream.schema(kinds[table]).parquet(path)
        streams.append(rows.select(F.lit(table).alias("table"), *[
            (F.struct(*kinds[n].names) if n == table else F.lit(None).cast(kinds[n])).alias(n) for n in CHANGE_TABLES]))
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def start_retractions(spark: SparkSession, feeds: Mapping[str, str], load_bundle: Callable[[], Bundle], rules: Rules, out_dir: str,
                      checkpoint_location: str, available_now: bool = True, fmt: str = "json") -> StreamingQuery:
    """Follow feeds of before and after images (table -> folder) and keep the published run up to date."""
    def batch(rows: DataFrame, epoch: int) -> None:
        rows = rows.persist()
        changes = {}
        for name in CHANGE_TABLES:
            table = rows.where(F.col("table") == name).select(f"{name}.*")
            changes[name] = table.drop(MONTH) if name == "pos_transaction" else table
        apply_changes(load_bundle(), rules, changes, out_dir, fmt, stream=checkpoint_location, batch=epoch)
        rows.unpersist()

    writer = image_stream(spark, feeds).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
