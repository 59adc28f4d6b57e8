"""Operator 6: mixing sources to target weights by Pareto order sampling.

DataFrame functions only. Every source gets a share of all words by weight;
a source's target over its size is the number of copies each of its documents
is expected to give. The whole part of that number is certain; for the rest a
sample is drawn in Pareto order: documents are ranked by

    (u / (1 - u)) / (p / (1 - p))

with u a uniform number made from the document's id and p the document's
chance of one more copy, and taken from the smallest rank on until the
source's remaining words are met. With s the source's fractional part and r
the square root of a document's size over the source's mean,
``p = s * (1 + (1 - s) * (r - 1) / (r + 1))``: between s squared and s (2 - s),
larger for longer documents.

No window spans a source. The cut of each source is found on a histogram of
the ranks (``BINS`` per source, refined once inside the bin the cut falls
in), so a source that holds a third of all rows is summed by every task, and
only the few documents of one refined bin are put in order together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from possum.llm.staging import staged

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
BINS = 1024
CLOSINGS = 3
SMALL_SOURCES = 20_000  # source tables up to this many rows are broadcast
_KEY = "__mix_key"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str = "mix") -> Column:
    """A number in (0, 1) from md5 of ``seed:key``; the same on every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    ``sizes`` has source and size. Sources weigh ``weights`` in turn, by code
    point order, null last. Targets share the sum of all sizes by weight; a
    target stops at ``max_copies`` times its source's size and the excess is
    reshared by weight until none is above.
    """
    spark = sizes.sparkSession
    per = staged(sizes.groupBy("source").agg(
        F.sum("size").cast("long").alias("source_size"),
        F.sum(F.sqrt(F.col("size").cast("double")) * F.col("size")).alias("pull")), "sources")
    # positions without a global window: ordered ranges, counted, then offset
    parts = staged(per.repartitionByRange(F.isnull("source"), F.col("source"))
                   .withColumn("part", F.spark_partition_id()), "source_ranges")
    counts = dict(parts.groupBy("part").agg(F.count(F.lit(1))).collect())  # one row per range
    offsets = [sum(n for p, n in counts.items() if p < k) for k in range(max(counts, default=0) + 1)]
    order = Window.partitionBy("part").orderBy(F.isnull("source"), F.col("source"))
    picks = F.array(*[F.lit(w) for w in weights])
    before = F.element_at(F.array(*[F.lit(n).cast("long") for n in offsets]), F.col("part") + 1)
    ranked = (parts.withColumn("place", before + F.row_number().over(order) - 1)
              .withColumn("weight", F.element_at(picks, (F.col("place") % len(weights) + 1).cast("int")))
              .withColumn("most", F.col("source_size") * max_copies)
              .select("source", "source_size", "pull", "weight", "most"))
    ranked = staged(ranked, "source_weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:  # each round fixes at least one more source at its most
        capped = F.lit(False) if level is None else F.col("most") < F.lit(level) * F.col("weight")
        fixed, open_weight = ranked.agg(F.sum(F.when(capped, F.col("most")).otherwise(0)),
                                        F.sum(F.when(capped, 0).otherwise(F.col("weight")))).first()
        if not open_weight:
            break
        new = (total - fixed) / open_weight
        if level is not None and new == level:
            break
        level = new
    share = F.lit(level if level is not None else 0.0) * F.col("weight")
    return ranked.withColumn("target", F.least(share.cast("double"), F.col("most").cast("double")))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a table after counting it; a larger one is joined by Spark's choice."""
    return F.broadcast(df) if df.limit(SMALL_SOURCES + 1).count() <= SMALL_SOURCES else df


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    right = right.withColumnRenamed("source", "__s")
    return left.join(right, F.col("source").eqNullSafe(F.col("__s")), how).drop("__s")


def _ranked(docs: DataFrame, facts: DataFrame, seed: str) -> DataFrame:
    """docs (doc_id, source, size) with their source's facts, odds, bin and sub.

    Documents that take no part in the draw have null odds.
    """
    docs = _same_source(docs, facts)
    r = F.sqrt(F.col("size").cast("double")) * F.col("source_size") / F.col("pull")
    p = F.col("share") * (1 + (1 - F.col("share")) * (r - 1) / (r + 1))
    p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    u = uniform(F.col("doc_id"), seed)
    docs = docs.withColumn("odds", F.when((F.col("size") > 0) & (F.col("rest") > 0), (u / (1 - u)) / (p / (1 - p))))
    # odds / (1 + odds) is in (0, 1) and keeps the order: two levels of bins
    place = F.col("odds") / (1 + F.col("odds")) * BINS
    docs = docs.withColumn("bin", F.least(F.floor(place), F.lit(BINS - 1)).cast("int"))
    return docs.withColumn("sub", F.least(F.floor((place - F.col("bin")) * BINS), F.lit(BINS - 1)).cast("int"))


def _drawn() -> Column:
    """Whether a ranked document lies before its source's cut, or closes its gap."""
    before = (F.when(F.col("odds").isNull(), False)
              .when(F.col("cut_bin").isNull(), True)
              .when(F.col("bin") != F.col("cut_bin"), F.col("bin") < F.col("cut_bin"))
              .when(F.col("cut_sub").isNull(), True)
              .when(F.col("sub") != F.col("cut_sub"), F.col("sub") < F.col("cut_sub"))
              .when(F.col("last").isNull(), False)
              .otherwise(F.struct("odds", "doc_id") <= F.col("last")))
    closes = F.col("odds").isNotNull() & F.exists("closing", lambda x: x["doc_id"].eqNullSafe(F.col("doc_id")))
    return F.coalesce(before, F.lit(False)) | closes


def source_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
                seed: str = "mix") -> DataFrame:
    """One row per source: its facts, the cut of its Pareto order and the documents that close its gap.

    sizes has doc_id, source, size. The cut leaves a gap smaller than the
    document it stops at; in ``CLOSINGS`` rounds the document left out that
    fills it best is added (ties to the smallest doc_id, null first; the last
    round may pass the target if that brings the source nearer).
    """
    targets = source_targets(sizes, weights, max_copies)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = (targets.withColumn("whole", F.least(F.floor(ratio), F.lit(max_copies)).cast("long"))
               .withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
               .withColumn("share", F.when(F.col("source_size") > 0,
                                           F.col("rest") / F.col("source_size")).otherwise(0.0)))
    facts = staged(targets.select("source", "source_size", "target", "whole", "rest", "share", "pull"), "facts")
    ranked = staged(_ranked(sizes, _small(facts), seed).filter(F.col("odds").isNotNull())
                    .select("doc_id", "source", "size", "rest", "odds", "bin", "sub"), "ranked")

    def cut(rows: DataFrame, level: str, rest: str) -> DataFrame:
        """source, the level's value the cut falls in, words still open before it."""
        hist = rows.groupBy("source", level).agg(F.sum("size").alias("words"), F.max(rest).alias("open"))
        run = Window.partitionBy("source").orderBy(level)
        hist = hist.withColumn("upto", F.sum("words").over(run))
        return (hist.filter(F.col("upto") > F.col("open")).groupBy("source")
                .agg(F.min(F.struct(F.col(level), (F.col("open") - F.col("upto") + F.col("words")).alias("open"))).alias("c"))
                .select("source", F.col(f"c.{level}").alias(f"cut_{level}"), F.col("c.open").alias(f"open_{level}")))

    first = staged(cut(ranked, "bin", "rest"), "cut1")
    inside = _same_source(ranked, _small(first)).filter(F.col("bin") == F.col("cut_bin"))
    second = staged(cut(inside, "sub", "open_bin"), "cut2")
    last = _same_source(inside, _small(second)).filter(F.col("sub") == F.col("cut_sub"))
    run = Window.partitionBy("source").orderBy(F.struct("odds", "doc_id")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    third = staged(last.withColumn("upto", F.sum("size").over(run)).groupBy("source").agg(
        F.max(F.when(F.col("upto") <= F.col("open_sub"), F.struct("odds", "doc_id"))).alias("last")), "cut3")
    plan = _same_source(_same_source(_same_source(facts, first, "left"), second, "left"), third, "left")
    kind = sizes.schema["doc_id"].dataType.simpleString()
    plan = staged(plan.drop("open_bin", "open_sub").withColumn(
        "closing", F.array().cast(f"array<struct<doc_id:{kind}>>")), "plan")
    for k in range(CLOSINGS):
        plan = staged(_close(ranked, plan, k == CLOSINGS - 1), "plan")
    return plan


def _close(ranked: DataFrame, plan: DataFrame, last: bool) -> DataFrame:
    """Add to each source's plan the left-out document that fills its gap best."""
    cuts = _small(plan.select("source", "cut_bin", "cut_sub", "last", "closing"))
    docs = _same_source(ranked, cuts).withColumn("extra", _drawn())
    gaps = docs.groupBy("source").agg(
        (F.max("rest") - F.sum(F.when(F.col("extra"), F.col("size")).otherwise(0))).alias("gap"))
    left_out = (_same_source(docs.filter(~F.col("extra")), _small(gaps))
                .groupBy("source", "doc_id").agg(F.sum("size").alias("adds"), F.max("gap").alias("gap")))
    miss = F.abs(F.col("gap") - F.col("adds"))
    fits = miss < F.col("gap") if last else F.col("adds") <= F.col("gap")
    pick = left_out.filter(fits).groupBy("source").agg(
        F.min(F.struct(miss.alias("miss"), F.struct("doc_id").alias("one"))).alias("pick"))
    more = F.when(F.col("pick").isNotNull(), F.array("pick.one")).otherwise(F.array().cast(plan.schema["closing"].dataType))
    return _same_source(plan, pick, "left").withColumn("closing", F.concat("closing", more)).drop("pick")


def apply_plan(docs: DataFrame, plan: DataFrame, seed: str = "mix") -> DataFrame:
    """docs (with doc_id, source, size among their columns) with source_size, target, copies.

    Nothing but the plan, one row per source, moves. Copies are whole, from 0
    to the plan's most. Documents of size 0 take the certain copies and are
    never drawn. Rows with one doc_id share their random number, so repeated
    rows are taken or left together.
    """
    out = _ranked(docs, _small(plan), seed)
    return out.select(*docs.columns, "source_size", "target", (F.col("whole") + _drawn().cast("long")).alias("copies"))


def _sizes(docs: DataFrame) -> DataFrame:
    return staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source",
        id_col: str = "doc_id", **kwargs) -> DataFrame:
    """Mix documents: doc_id, source, size, source_size, target, copies, taken.

    Null texts have size 0; a null source is a source of its own, last in
    order; null ids are one id. An empty table gives no rows. Other columns
    of the input are not read.
    """
    sizes = _sizes(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")))
    return apply_plan(sizes, source_plan(sizes, **kwargs)).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, **kwargs) -> DataFrame:
    """The documents the mix takes, whole, with copies (1 or more) and taken.

    docs has doc_id, source and text; its other columns are kept, whatever
    their names, but for those named copies and taken.
    """
    plan = source_plan(_sizes(docs), **kwargs)
    kept = docs.drop("copies", "taken")
    whole = F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("__mix_row")  # no name of it meets the plan's
    out = apply_plan(kept.select("doc_id", "source", word_count(F.col("text")).alias("size"), whole), plan)
    return (out.filter(F.col("copies") > 0).select("__mix_row.*", "copies", (F.col("copies") * F.col("size")).alias("taken")))
