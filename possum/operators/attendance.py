"""Attendance from six in/out punch pairs per person and day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.bundle import Bundle
from possum.functions.dates import date_lookback
from possum.functions.text import ustrip
from possum.operators.base import live_stores
from possum.rules import Rules

PAIRS = 6
DAY_MINUTES = 1440


def _minutes(ts):
    return F.hour(ts) * 60 + F.minute(ts)


def attendance(bundle: Bundle, rules: Rules, as_of: datetime) -> DataFrame:
    """branch, iso, date, StoreName, name, no, uid, punches, hours.

    ``punches`` is array<struct<in,out>> ('HH:mm' or null) of the pairs with
    at least one side; ``hours`` adds the complete pairs, a pair past
    midnight wrapping by 1440 minutes. Days without punches are dropped.
    All row-local: no shuffle but the store join.
    """
    pv = bundle["presence_view"].where(F.col("PreDate") >= date_lookback(as_of, rules.attendance_days))
    pv = pv.join(live_stores(bundle).select("branch", "StoreID", "StoreName"), ["branch", "StoreID"])
    li = [F.col(f"Login{i}") for i in range(1, PAIRS + 1)]
    lo = [F.col(f"Logout{i}") for i in range(1, PAIRS + 1)]
    # worked minutes and the "any punch" test as plain column expressions
    # (whole-stage codegen); the list itself needs filter/transform
    worked = sum((F.coalesce(F.pmod(_minutes(o) - _minutes(i), F.lit(DAY_MINUTES)), F.lit(0))
                  for i, o in zip(li, lo)), F.lit(0))
    any_punch = F.coalesce(*[c for pair in zip(li, lo) for c in pair]).isNotNull()
    pairs = F.array(*[F.struct(i.alias("li"), o.alias("lo")) for i, o in zip(li, lo)])
    punches = F.transform(F.filter(pairs, lambda p: p["li"].isNotNull() | p["lo"].isNotNull()),
                          lambda p: F.struct(F.date_format(p["li"], "HH:mm").alias("in"),
                                             F.date_format(p["lo"], "HH:mm").alias("out")))
    return pv.where(any_punch).select(
        "branch", F.date_format("PreDate", "yyyy-MM-dd").alias("iso"),
        F.date_format("PreDate", "dd/MM").alias("date"), "StoreName",
        ustrip(F.coalesce(F.col("Name"), F.lit(""))).alias("name"),
        F.col("UserNo").alias("no"), F.col("UserID").cast("string").alias("uid"),
        punches.alias("punches"), F.round(worked / F.lit(60.0), 2).alias("hours"))


def flatten_attendance(att: DataFrame) -> DataFrame:
    """One row per punch (for value checks)."""
    return att.select("branch", "iso", "date", "StoreName", "name", "no", "uid", "hours",
                      F.posexplode("punches").alias("pos", "p")).select(
        "branch", "iso", "date", "StoreName", "name", "no", "uid", "hours",
        (F.col("pos") + 1).cast("int").alias("punch"), F.col("p.in").alias("in"),
        F.col("p.out").alias("out"))
