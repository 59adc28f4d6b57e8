"""A bundle is the set of canonical POS tables of one or more branches.

Every table carries a ``branch`` string column. The ``store`` table also
carries ``StoreNameOrig`` (the name in the branch's own database) next to
``StoreName`` (the name shown, which is the branch label when one is set).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Branch:
    name: str
    label: str | None = None


@dataclass(frozen=True)
class Bundle:
    tables: Mapping[str, DataFrame]
    branches: tuple[Branch, ...] = field(default=(Branch("main"),))

    def __getitem__(self, name: str) -> DataFrame:
        try:
            return self.tables[name]
        except KeyError:
            raise KeyError(f"bundle has no table {name!r}") from None

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    @property
    def spark(self) -> SparkSession:
        return next(iter(self.tables.values())).sparkSession

    def with_tables(self, **tables: DataFrame) -> "Bundle":
        merged = dict(self.tables)
        merged.update(tables)
        return Bundle(merged, self.branches)

    def with_branch_order(self, df: DataFrame) -> DataFrame:
        """``df`` with branch_rank and branch_label of its branch, from the
        configuration (literals in the plan, no join). A branch missing from
        the configuration keeps its rows: it ranks after the configured ones
        (then by name) and has no label."""
        rank, label = F.lit(len(self.branches)), F.lit(None).cast("string")
        for i, b in reversed(list(enumerate(self.branches))):
            here = F.col("branch") == F.lit(b.name)
            rank = F.when(here, F.lit(i)).otherwise(rank)
            label = F.when(here, F.lit(b.label).cast("string")).otherwise(label)
        return df.withColumn("branch_rank", rank).withColumn("branch_label", label)
