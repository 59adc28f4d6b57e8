"""The sale month stored with the sale facts.

Lines carry no date, so nothing lets a reader skip old ones. Stored with the
month of their transaction, the three sale facts are written one folder per
month: windows (D9, D21), one day (D25) and the incremental refresh then read
the folders they need.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.operators.base import MONTH

SALE_FACTS = ("pos_transaction", "transaction_entry", "tender_entry")
PARTITION_BY = {name: MONTH for name in SALE_FACTS}
# lines without a transaction: read only by a scan of all months
NO_MONTH = "none"


def with_sale_months(bundle: Bundle) -> Bundle:
    """The bundle with SaleMonth (yyyy-MM) in its sale facts; no row is lost.

    Write it with ``write_bundle(bundle, root, PARTITION_BY)``.
    """
    t = bundle["pos_transaction"].drop(MONTH)
    month = F.coalesce(F.date_format("SaleTime", "yyyy-MM"), F.lit(NO_MONTH))
    tables = {"pos_transaction": t.withColumn(MONTH, month)}
    months = t.select("branch", "TransactionID", month.alias(MONTH))
    for name in SALE_FACTS[1:]:
        lines = bundle[name].drop(MONTH).join(months, ["branch", "TransactionID"], "left")
        tables[name] = lines.withColumn(MONTH, F.coalesce(MONTH, F.lit(NO_MONTH)))
    return bundle.with_tables(**tables)
