"""Item cost: D6 imputation by code prefix, D7 manual price list, D8 stock
revaluation at the final cost."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from possum.functions import codes
from possum.functions.money import whole
from possum.rules import Rules


_PREFIX = ["branch", "lvl", "pre"]


def cost_multiset(items: DataFrame) -> DataFrame:
    """branch, lvl, pre, cost, n: how often each known cost stands under each code prefix.

    A state for D6 that can be kept: with the number of items behind every cost,
    the next highest cost of a prefix is there when the highest one goes.
    """
    return (items.where((F.col("p") > 0) & (F.col("b") != ""))
            .select("branch", F.col("p").alias("cost"), F.explode(codes.prefix_levels(F.col("b"))).alias("e"))
            .groupBy("branch", F.col("e.lvl").alias("lvl"), F.col("e.pre").alias("pre"), "cost").agg(F.count(F.lit(1)).alias("n")))


def change_multiset(state: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """The state after items (branch, b, p) were removed and added: only these are read.

    Removing a cost that the state does not hold fails.
    """
    less = cost_multiset(removed).withColumn("n", -F.col("n"))
    g = state.unionByName(less).unionByName(cost_multiset(added)).groupBy(*_PREFIX, "cost").agg(F.sum("n").alias("n"))
    wrong = F.when(F.col("n") < 0, F.raise_error(F.lit("a removed cost is not in the state; build it anew")).cast("bigint"))
    return g.withColumn("n", F.coalesce(wrong, "n")).where(F.col("n") > 0)


def highest_costs(state: DataFrame) -> DataFrame:
    """branch, lvl, pre, fill: the highest known cost of each prefix."""
    return state.groupBy(*_PREFIX).agg(F.max("cost").alias("fill"))


def impute_cost(items: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Fill a zero cost from items sharing a code prefix.

    Levels: 1 = year+season+model+colour, 2 = season+model+colour,
    3 = model+colour; each level keeps the highest known cost per prefix and
    the first level with a hit wins. Lookups are built from observed costs
    only (no cascade). Prefixes keep their case.

    Plan: one aggregate builds all three lookups (known items exploded into
    <= 3 (level, prefix) rows). The items to fill are exploded the same way
    as slim (key, level, prefix) rows, joined on (branch, level, prefix) and
    reduced to the best fill per key; that small frame is joined once to all
    items. ``items`` is read three times: pass a staged frame. ``known`` is the
    lookup of a kept state (:func:`highest_costs`) instead of a pass over the
    items.
    """
    lv = codes.prefix_levels(F.col("b"))
    if known is None:
        known = (items.where((F.col("p") > 0) & (F.col("b") != ""))
                 .select("branch", "p", F.explode(lv).alias("e"))
                 .groupBy("branch", F.col("e.lvl").alias("lvl"), F.col("e.pre").alias("pre"))
                 .agg(F.max("p").alias("fill")))
    slim = (items.where((F.col("p") == 0) & (F.col("b") != ""))
            .select("branch", "key", F.explode(lv).alias("e"))
            .select("branch", "key", F.col("e.lvl").alias("lvl"), F.col("e.pre").alias("pre")))
    best = slim.join(known, ["branch", "lvl", "pre"]).groupBy("branch", "key").agg(
        F.min_by("fill", "lvl").alias("fill"))
    # a key is in ``best`` only if its cost is zero
    return items.join(best, ["branch", "key"], "left").withColumn(
        "p", F.coalesce(F.col("fill"), F.col("p"))).select(*items.columns)


def apply_price_list(items: DataFrame, price_list: Sequence[tuple[str, str | Decimal]]) -> DataFrame:
    """The first list entry whose name is a substring of the item name
    sets the cost, over everything else. An empty list changes nothing.

    The list is driver-side configuration (a hand-kept list), so it becomes
    one literal array and a filter over it: a projection, no join and no
    shuffle, for a list of any length.
    """
    if not price_list:
        return items
    entries = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(Decimal(str(price))).cast("decimal(18,2)").alias("price"))
                        for name, price in price_list])
    hits = F.filter(entries, lambda e: F.col("n").contains(e["name"]))
    return items.withColumn("p", F.coalesce(F.get(hits, F.lit(0))["price"], F.col("p")))


GRAM = 3


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """The distinct substrings of these sizes (0: the empty one)."""
    def of(size: int) -> Column:
        if size == 0:
            return F.array(F.lit(""))
        starts = F.sequence(F.lit(1), F.length(text) - (size - 1))
        return F.when(F.length(text) >= size, F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))).otherwise(
            F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of(k) for k in sizes]))


def apply_long_price_list(items: DataFrame, price_list: DataFrame) -> DataFrame:
    """D7 for a list of any length: price_list has position, name, price.

    An inverted index instead of a comparison of every name with every entry.
    A name that contains an entry contains each of the entry's trigrams, so an
    entry is posted under one trigram only, the one that the fewest item names
    have; an entry with a trigram that no name has can't match and is gone.
    Distinct names are joined with the postings on their trigrams, ``contains``
    is verified, and the first position wins (ties: the lowest price); of entries
    of one name only that one can win, so one of each name is posted. Entries
    shorter than a trigram are posted under themselves; names list their shorter
    substrings only if there are such entries. A null name or entry matches
    nothing. The plan has equality joins alone.
    """
    entries = price_list.select("position", "name", F.col("price").cast("decimal(18,2)").alias("price")).where(F.col("name").isNotNull())
    entries = entries.groupBy("name").agg(F.min(F.struct("position", "price")).alias("e")).select("e.position", "name", "e.price")
    names = items.select("n").where(F.col("n").isNotNull()).distinct()
    sizes = F.array_sort(F.collect_set(F.when(F.length("name") < GRAM, F.length("name"))))
    short = entries.agg(sizes.alias("sizes")).first()["sizes"]      # of 0, 1, 2
    grams = names.select("n", F.explode(_grams(F.col("n"), [*short, GRAM])).alias("gram"))
    common = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    own = F.when(F.length("name") < GRAM, F.array("name")).otherwise(_grams(F.col("name"), [GRAM]))
    wanted = entries.select("position", "name", "price", F.size(own).alias("size"), F.explode(own).alias("gram")).join(common, "gram")
    posted = (wanted.groupBy("position", "name", "price", "size").agg(F.count(F.lit(1)).alias("found"), F.min_by("gram", F.struct("df", "gram")).alias("gram"))
              .where(F.col("found") % F.col("size") == 0))      # all trigrams known; equal entries count together
    hits = grams.join(posted.select("gram", "position", "name", "price"), "gram").where(F.col("n").contains(F.col("name")))
    best = hits.groupBy("n").agg(F.min(F.struct("position", "price"))["price"].alias("list_price"))
    return items.join(best, "n", "left").withColumn("p", F.coalesce("list_price", "p")).select(*items.columns)


def revalue_stock(summary: DataFrame, by_dept: DataFrame, items: DataFrame,
                  rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Stock value at the final item cost.

    Sum qty x cost over positive store quantities of items with a positive
    cost, by store and by (department, store), on the stores' own names.
    A positive sum replaces D1.StockValue / D3.Value, rounded half to even.
    """
    entries = (items.where(F.col("p") > 0)
               .select("branch", "p", F.coalesce(F.nullif(F.col("d"), F.lit("")),
                                                  F.lit(rules.no_department)).alias("dept"),
                       F.explode("s").alias("store", "qty"))
               .where(F.col("qty") > 0)
               .withColumn("v", F.col("qty") * F.col("p")))
    by_store = entries.groupBy("branch", F.col("store").alias("StoreNameOrig")).agg(
        F.sum("v").alias("sv"))
    by_dept_store = entries.groupBy("branch", F.col("dept").alias("Department"),
                                    F.col("store").alias("StoreNameOrig")).agg(F.sum("v").alias("sv"))
    s2 = summary.join(by_store, ["branch", "StoreNameOrig"], "left").withColumn(
        "StockValue", F.when(F.col("sv") > 0, whole(F.col("sv"))).otherwise(F.col("StockValue"))
    ).select(*summary.columns)
    d2 = by_dept.join(by_dept_store, ["branch", "Department", "StoreNameOrig"], "left").withColumn(
        "Value", F.when(F.col("sv") > 0, whole(F.col("sv"))).otherwise(F.col("Value"))
    ).select(*by_dept.columns)
    return s2, d2
