"""M1 branch union, M2 relabel of store maps, M3 keyed merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum import schemas
from possum.bundle import Branch, Bundle
from possum.sources.optional import empty


def union_branches(parts: Sequence[tuple[Bundle, str | None]]) -> Bundle:
    """M1: one bundle over several branch databases.

    Each part already tags its rows with its branch. An optional table a
    branch lacks counts as empty (S2); a missing required table is an error.
    A label replaces the shown store name of every store of that branch (``StoreNameOrig`` keeps
    the branch's own name for the store maps, see M2).
    """
    if not parts:
        raise ValueError("no branches")
    names = sorted(set().union(*[set(b.tables) for b, _ in parts]))
    branches: list[Branch] = []
    tables: dict[str, list[DataFrame]] = {n: [] for n in names}
    for bundle, label in parts:
        for br in bundle.branches:
            branches.append(Branch(br.name, label))
        for n in names:
            if n in bundle:
                df = bundle[n]
            elif n in schemas.OPTIONAL:   # S2: a branch without the table
                df = empty(bundle.spark, n).withColumn("branch", F.lit(bundle.branches[0].name))
            else:
                raise ValueError(f"branch {bundle.branches[0].name} has no table {n}")
            if n == "store" and label is not None:
                df = df.withColumn("StoreName", F.lit(label))
            tables[n].append(df)
    merged = {n: reduce(lambda a, b: a.unionByName(b), dfs) for n, dfs in tables.items()}
    return Bundle(merged, tuple(branches))


def relabel_branch(df: DataFrame, bundle: Bundle, map_col: str = "s") -> DataFrame:
    """M2: in a labelled branch, collapse a store map to ``{label: sum}``."""
    vtype = df.schema[map_col].dataType.valueType
    labelled = bundle.with_branch_order(df)
    total = F.aggregate(F.map_values(map_col), F.lit(0).cast(vtype), lambda a, x: (a + x).cast(vtype))
    return labelled.withColumn(
        map_col, F.when(F.col("branch_label").isNotNull(),
                        F.create_map(F.col("branch_label"), total)).otherwise(F.col(map_col))
    ).select(*df.columns)


def merge_sum(df: DataFrame, keys: Sequence[str], sums: Sequence[str],
              order: Sequence[str]) -> DataFrame:
    """M3: group by ``keys``; add ``sums``; other columns come from the first
    row in ``order`` (e.g. branch rank). Partial/final aggregate."""
    others = [c for c in df.columns if c not in keys and c not in sums and c not in order]
    aggs = [F.sum(c).alias(c) for c in sums]
    if others:
        aggs.append(F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
    g = df.groupBy(*keys).agg(*aggs)
    cols = [*keys, *sums] + [F.col(f"_first.{c}").alias(c) for c in others]
    return g.select(*cols)
