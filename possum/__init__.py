"""possum: retail point-of-sale analytics as Spark DataFrame jobs.

Every operator takes DataFrames (a :class:`possum.bundle.Bundle` of canonical
POS tables) and returns a lazy DataFrame; nothing is collected to the driver.

Typical use::

    from possum import Rules, read_branch, union_branches, run_daily_job, run_stock_job
"""

from possum.bundle import Branch, Bundle
from possum.operators.branches import union_branches
from possum.plans.daily_job import run_daily_job
from possum.plans.stock_job import run_stock_job
from possum.rules import Rules
from possum.sources.jdbc import JdbcBranch, read_branch
from possum.sources.parquet import read_bundle
from possum.sources.tables import read_bundle_tables

__all__ = ["Branch", "Bundle", "JdbcBranch", "Rules", "read_branch", "read_bundle", "read_bundle_tables",
           "run_daily_job", "run_stock_job", "union_branches"]
