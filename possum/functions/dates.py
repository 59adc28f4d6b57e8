"""Date and time expressions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ts_literal(as_of: datetime | str) -> str:
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    return as_of.strftime("%Y-%m-%d %H:%M:%S")


def lookback(as_of: datetime | str, amount: int, unit: str) -> Column:
    """``as_of - INTERVAL amount unit`` keeping the time of day.

    Month and year steps clamp to the month end (03-31 minus 1 month is
    02-29). Folded to a literal by the optimizer, so it reaches the scan.
    """
    if unit.upper() not in ("YEAR", "MONTH", "DAY"):
        raise ValueError(unit)
    return F.expr(f"TIMESTAMP_NTZ '{_ts_literal(as_of)}' - INTERVAL '{int(amount)}' {unit.upper()}")


def date_lookback(as_of: datetime | str, days: int) -> Column:
    """``CAST(as_of AS DATE) - days`` (date grained)."""
    return F.expr(f"DATE '{_ts_literal(as_of)[:10]}' - INTERVAL '{int(days)}' DAY")


def day_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def minute_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def day_key_to_iso(key: Column) -> Column:
    """``d/m/yyyy`` -> ``yyyy-mm-dd`` as Python's ``zfill(2)`` pads; other keys stay.

    A key with exactly two slashes is re-keyed; anything else is returned as is.
    """
    parts = F.split(key, "/", -1)

    def zfill2(p: Column) -> Column:
        return (F.when(F.length(p) >= 2, p)
                .when(p.isin("+", "-"), F.concat(p, F.lit("0")))
                .otherwise(F.lpad(p, 2, "0")))

    return F.when(F.size(parts) == 3,
                  F.concat_ws("-", parts[2], zfill2(parts[1]), zfill2(parts[0]))
                  ).otherwise(key)


def today_iso(as_of: datetime | str | date) -> str:
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    return as_of.strftime("%Y-%m-%d")
