"""Money expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType


def dec(col: Column, scale: int, precision: int = 18) -> Column:
    """SQL ``CAST(x AS DECIMAL(p, s))``: rounds half up."""
    return col.cast(DecimalType(precision, scale))


def cost_ladder(av_cost_wo_tax: Column, cost_wo_tax: Column, avg_cost: Column,
                vat: Decimal) -> Column:
    """First non-zero of the pre-tax average cost, pre-tax cost, average cost / VAT."""
    return dec(F.coalesce(F.nullif(av_cost_wo_tax, F.lit(0)),
                          F.nullif(cost_wo_tax, F.lit(0)),
                          F.nullif(avg_cost / F.lit(vat), F.lit(0))), 2)


def out(col: Column) -> Column:
    """Final projection of an exact amount: decimal -> double, once, last."""
    return col.cast(DoubleType())


def whole(col: Column) -> Column:
    """Python ``round(x)`` on an exact decimal: half to even, 0 places."""
    return F.bround(col, 0)
